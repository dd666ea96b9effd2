"""Sell-through feeds derived from order tables (lineitem, orders, customer, part), for the query registry.

A brand is a client, a market segment a retailer, a supplier a store. Nothing here makes up rows: every feed row comes
from a line item, so its number grows with the tables."""
