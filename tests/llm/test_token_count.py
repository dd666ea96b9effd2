from hypothesis import given, settings, strategies as st

from sellthrough.llm.token_count import VOCABULARY, Counting, build, count_with_edits, counter, ordered, recount, redactions
from .helpers import documents, prose, rng

TEXT = st.text(alphabet="ab  \n\t's1.,éß日\x1c ", max_size=80)


@settings(max_examples=300, deadline=None)
@given(TEXT, st.lists(st.tuples(st.integers(0, 80), st.integers(0, 6), st.text(alphabet="a \n's1é", max_size=5)), max_size=5), st.sampled_from([1, 4, 16]))
def test_tree_follows_any_edit(text, edits, size):
    count = counter(VOCABULARY)
    tree = build(text, Counting(segment=size))
    assert tree.total() == count(text)
    for start, length, new in edits:
        start = min(start, len(text))
        stop = min(start + length, len(text))
        after = tree.edit(text, start, stop, new, count)
        assert after == text[:start] + new + text[stop:]
        text = after
        assert tree.total() == count(text)


def test_edits_of_a_table_and_from_stored_trees(spark):
    text = prose(rng(4), 3000) + " mail me@host.org or +49 (89) 123-4567 now"
    rows = documents(spark, [(1, text), (2, None), (3, ""), (4, "x" * 200_000), (5, "me@host.org"), (5, "me@host.org"), (None, "call 0123456789")])
    made = redactions(rows)
    got = sorted((tuple(r) for r in count_with_edits(made).collect()), key=str)
    count = counter(VOCABULARY)
    by_id = {r[0]: r for r in got}
    masked = text.replace("me@host.org", "[redacted]").replace("+49 (89) 123-4567", "[redacted]")
    assert (by_id[1][1], by_id[1][4], by_id[1][5]) == (count(text), 2, count(masked)) and sum(by_id[1][2]) == len(text) and sum(by_id[1][3]) == count(text)
    assert by_id[1][6] < 2000  # of some 17,000 characters
    assert by_id[2][1:] == by_id[3][1:] == (0, [], [], 0, 0, 0) and by_id[4][1] == count("x" * 200_000)
    assert len(got) == 7 and by_id[5][5] == count("[redacted]") and by_id[None][4] == 1
    trees = count_with_edits(made.filter("doc_id in (1, 3)"))
    assert {r.doc_id: r.edited_tokens for r in recount(trees, made).collect()} == {1: count(masked), 3: 0}
    assert count_with_edits(redactions(documents(spark, []))).collect() == []


def test_bounds_and_overlaps_of_edits():
    assert ordered([(5, 9, "a"), (7, 12, "b"), (-3, 1, None), (90, 99, "c"), (4, 2, "d")], 10) == [(10, 10, "c"), (7, 10, "b"), (0, 1, "")]
    assert ordered(None, 5) == []
