import os
import sys
from datetime import date
from decimal import Decimal

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from sellthrough import schemas as S  # noqa: E402
from sellthrough.session import build_session, local_rows  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session("tests", "local[4]", **{
        "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared"))})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def d(text):
    return date.fromisoformat(text) if text else None


def money(x):
    return Decimal(str(x)).quantize(Decimal("0.01"))


def rows(df, *columns):
    """Rows as sorted tuples."""
    found = (tuple(r) for r in df.select(*columns or df.columns).collect())
    return sorted(found, key=lambda r: tuple(str(x) for x in r))


def one_load(spark, files, *, client="C101", retailer="R201", level="serial", window=("2026-08-29", "2026-09-26"), load="L1"):
    """(files, loads) of one load over the given {file: week}."""
    loads = local_rows(spark, [(load, f"{client}_{retailer}", client, retailer, level, "automation", d(window[0]), d(window[1]))], S.LOADS)
    return local_rows(spark, [(load, f, d(w)) for f, w in files.items()], S.FILES), loads


def raw_rows(spark, lines, columns):
    """Raw feed rows from (source_file, cells...) with the given columns; other columns are absent from the layout."""
    made = []
    for line in lines:
        cells = dict(zip(columns, line[1:]))
        made.append((line[0], *[cells.get(c) for c in S.FEED_COLUMNS], list(columns), list(line[1:]), None))
    return local_rows(spark, made, S.RAW_FEED)
