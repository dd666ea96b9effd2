"""Lines that recur across documents, by a log-template tree of fixed depth (operator 8), with DataFrame functions only.

A line's tokens are its runs of characters between white space, with every number replaced by `<*>`. The tree's leaf of a line is its number of
tokens and its first `depth` tokens. Within a leaf every token has a frequency at its place. A line's least frequent places, as many as the
least share `similar` of fixed tokens allows, are its variable fields (ties: the first places); what is left is its template. So a name is a
field beside the words around it whether it occurs once or a million times. A line recurs if it, as it is, or its template stands in `docs`
documents.

Documents of equal text count as one. Near copies would make lines of their own recur, so documents count only if at least a share `own` of
their words is in lines that don't recur: a line has to recur in documents that have something else to say. Recurring lines are dropped from
all documents, whatever their share of them.

Every line is tokenised once, to two hashes. Lines of leaves in which something may recur are looked at word by word. A text is judged by the
hashes of its raw lines. Counts are partial sums; hot keys of joins are split off, so a line of a third of all documents costs a row per task."""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from sellthrough.llm.joins import join_split
from sellthrough.operators.joins import join_bounded
from sellthrough.session import materialise

FIELD = "<*>"
GAPS = r"[\x20\x09-\x0D]+"
WHITE = " \t\n\x0b\x0c\r"


@dataclass(frozen=True)
class Templates:
    """docs: documents that make a template recurring. depth: leading tokens of a leaf. similar: least share of fixed tokens, percent. own: least
    share of words outside recurring lines, percent, of documents that count."""
    docs: int = 10
    depth: int = 3
    similar: int = 80
    own: int = 20


def tokens(line: Column) -> Column:
    return F.array_remove(F.split(F.regexp_replace(line, "[0-9]+", FIELD), GAPS), "")


def _is_blank(line: Column) -> Column:
    return F.btrim(line, F.lit(WHITE)) == ""


def _lines(documents: DataFrame) -> DataFrame:
    """(t, r, line): hashes of the text and of each of its lines that isn't blank."""
    rows = documents.select(F.xxhash64("text").alias("t"), F.explode(F.split("text", "\n")).alias("line"))
    return rows.filter(~_is_blank(F.col("line"))).select("t", F.xxhash64("line").alias("r"), "line")


def _template(places: Column, size: Column, p: Templates) -> Column:
    """Hash of what is fixed in a line, from (times, place, token) of its tokens."""
    fields = F.floor(size * (100 - p.similar) / 100).cast("int")
    fixed = F.slice(F.sort_array(places), fields + 1, F.size(places) - fields)
    return F.xxhash64(F.sort_array(F.transform(fixed, lambda x: F.struct(x.place.alias("place"), x.token.alias("token")))))


def _templates(documents: DataFrame, lines: DataFrame, p: Templates) -> DataFrame:
    """(h, template) of the lines in leaves where more than one line stands and `docs` lines stand together. lines: (leaf, h, size, n, r)."""
    leaves = lines.groupBy("leaf").agg(F.sum("n").alias("lines"), F.count("*").alias("n")).filter((F.col("lines") >= p.docs) & (F.col("n") > 1))
    leaves = materialise(leaves.select("leaf", "n"), "leaves")
    mixed = materialise(join_split(lines.withColumnRenamed("n", "docs"), leaves, ["leaf"], merge=False).drop("n"), "mixed")
    # One raw line stands for all of a token list.
    texts = join_bounded(_lines(documents).drop("t"), mixed.select("r", "h"), "r", "inner", mixed.count()).groupBy("h").agg(F.min("line").alias("line"))
    words = materialise(texts.select("h", F.posexplode(tokens(F.col("line"))).alias("place", "token")).join(mixed.drop("r"), "h"), "words")
    times = words.groupBy("leaf", "place", "token").agg(F.sum("docs").alias("times"), F.count("*").alias("n"))
    counted = join_split(words, materialise(times, "times"), ["leaf", "place", "token"], merge=False)
    found = counted.groupBy("leaf", "h", "size").agg(F.collect_list(F.struct("times", "place", "token")).alias("places"))
    return found.select("h", F.xxhash64("leaf", _template(F.col("places"), F.col("size"), p)).alias("template"))


def _recurring(counts: DataFrame, templates: DataFrame, p: Templates) -> DataFrame:
    """h of the lines that recur as they are or by their template. counts: (h, n)."""
    named = counts.join(templates, "h")
    often = named.groupBy("template").agg(F.sum("n").alias("docs"), F.count("*").alias("n")).filter(F.col("docs") >= p.docs)
    alike = join_split(named.drop("n"), materialise(often, "often"), ["template"], merge=False).select("h")
    return materialise(counts.filter(F.col("n") >= p.docs).select("h").union(alike).distinct(), "recurring")


def _bad_lines(documents: DataFrame, p: Templates) -> DataFrame:
    """(t, bad_lines): the raw hashes of the recurring lines of each text that has some."""
    rows = _lines(documents).select("t", "r", tokens(F.col("line")).alias("w"))
    seen = rows.select("t", "r", F.size("w").alias("size"), F.xxhash64(F.size("w"), F.slice("w", 1, p.depth)).alias("leaf"), F.xxhash64("w").alias("h"))
    seen = materialise(seen.distinct(), "seen")
    lines = seen.groupBy("t", "leaf", "h", "size").agg(F.min("r").alias("r")).groupBy("leaf", "h", "size").agg(F.count("*").alias("n"), F.min("r").alias("r"))
    lines = materialise(lines, "lines")
    templates = materialise(_templates(documents, lines, p), "templates")

    # Counted once over all texts, then over those that have enough words of their own.
    found = _recurring(lines.select("h", "n"), templates, p)
    found = materialise(found.join(lines.select("h", "n"), "h"), "found")
    flagged = materialise(join_split(seen, found, ["h"], merge=False).select("t", "r", "h", "size"), "flagged")
    bad = flagged.select("t", "h", "size").distinct().groupBy("t").agg(F.sum("size").alias("bad"))
    words = seen.select("t", "h", "size").distinct().groupBy("t").agg(F.sum("size").alias("words"))
    speaking = words.join(bad, "t").filter((F.col("words") - F.col("bad")) * 100 >= F.col("words") * p.own).select("t")
    counts = flagged.join(speaking, "t", "left_semi").select("t", "h").distinct().groupBy("h").agg(F.count("*").alias("n"))
    final = _recurring(materialise(counts, "counts"), templates, p).join(lines.select("h", "n"), "h")
    return join_split(flagged, materialise(final, "final"), ["h"], merge=False).groupBy("t").agg(F.collect_set("r").alias("bad_lines"))


def drop_recurring_lines(documents: DataFrame, p: Templates = Templates()) -> DataFrame:
    """The documents with lines of recurring templates dropped from text, and n_lines (not blank) and n_dropped added.

    Null texts stay null, with 0 lines; empty ones stay empty. Blank lines and the order of lines are kept. Rows that repeat come back as often.
    An empty table gives no rows. Columns named n_lines, n_dropped are replaced; others are passed on."""
    names = [c for c in documents.columns if c not in ("n_lines", "n_dropped")]
    rows = documents.select(F.struct(*names).alias("row"), F.xxhash64("text").alias("t"))
    copies = documents.filter("text is not null").groupBy(F.xxhash64("text").alias("t")).agg(F.count("*").alias("n"))
    bad = materialise(_bad_lines(documents, p).join(copies, "t"), "bad")
    nothing = F.array().cast("array<bigint>")
    rows = (join_split(rows.filter("row.text is not null"), bad, ["t"], "left").select("row", F.coalesce("bad_lines", nothing).alias("bad_lines"))
            .unionByName(rows.filter("row.text is null").select("row", nothing.alias("bad_lines"))))
    lines = F.split(F.col("row.text"), "\n")
    kept = F.filter(lines, lambda x: _is_blank(x) | ~F.array_contains("bad_lines", F.xxhash64(x)))
    some = F.size("bad_lines") > 0
    rows = rows.withColumn("kept", F.when(some, kept))
    return rows.select(
        *[F.when(some, F.array_join("kept", "\n")).otherwise(F.col("row.text")).alias("text") if c == "text" else F.col(f"row.`{c}`") for c in names],
        F.coalesce(F.size(F.filter(lines, lambda x: ~_is_blank(x))), F.lit(0)).cast("long").alias("n_lines"),
        F.when(some, F.size(lines) - F.size("kept")).otherwise(0).cast("long").alias("n_dropped"))
