import pytest

from sellthrough.llm.line_dedup import Templates, drop_recurring_lines
from .helpers import documents, prose, rng

P = Templates(docs=4)


def run(spark, rows, p=P):
    found = drop_recurring_lines(documents(spark, rows), p)
    return {r.doc_id: (r.text, r.n_lines, r.n_dropped) for r in found.collect()}


def test_recurring_lines_and_templates_go(spark):
    r = rng(3)
    rows = []
    for i in range(12):
        own = [prose(r, 25), prose(r, 30)]
        lines = [own[0], "All rights  reserved.", own[1]]
        if i < 6:
            lines.append(f"Page {i} of 99 printed for the reader {'abcdef'[i]} today in this house")  # a number and a name vary
        rows.append((i, "\n".join(lines)))
    got = run(spark, rows)
    for i, text in rows:
        lines = text.split("\n")
        assert got[i] == (f"{lines[0]}\n{lines[2]}", len(lines), len(lines) - 2)


@pytest.mark.parametrize("n", [1000, 8000])
def test_fields_of_many_values_are_fields_at_any_size(spark, n):
    r = rng(n)
    first, last = ([f"{kind}{i}" for i in range(400)] for kind in ("Ann", "Berg"))
    first, last = ([w.translate(str.maketrans("0123456789", "abcdefghij")) for w in x] for x in (first, last))
    lines = [f"This article was written by {r.choice(first)} {r.choice(last)} for the evening edition of our paper" for _ in range(n)]
    own = [prose(r, 30) for _ in range(n)]
    got = run(spark, [(i, f"{own[i]}\n{lines[i]}") for i in range(n)], Templates())
    assert all(got[i] == (own[i], 2, 1) for i in range(n))


def test_footers_of_short_documents_and_short_lines_go(spark):
    r = rng(6)
    footer, own = prose(r, 60), [prose(r, 40) for _ in range(50)]
    got = run(spark, [(i, f"{x}\n{footer}") for i, x in enumerate(own)], Templates())
    assert all(got[i] == (x, 2, 1) for i, x in enumerate(own))
    got = run(spark, [(i, f"Read more\n{x}\nCookie Policy\n...\n版權所有") for i, x in enumerate(own)], Templates())
    assert all(got[i] == (x, 5, 4) for i, x in enumerate(own))


def test_copies_do_not_make_their_lines_recur_but_lose_what_does(spark):
    r = rng(5)
    shared = [prose(r, 12) for _ in range(6)]
    copies = [(i, "\n".join([*shared, prose(r, 3), "Imprint and contact"])) for i in range(8)]
    rare = [(10 + i, "\n".join([prose(r, 30), "Seen three times only"])) for i in range(3)]
    equal = [(20 + i, "Same text here\n" + shared[0][:5] + " x y z") for i in range(9)]  # one document, however often
    others = [(40 + i, f"{prose(r, 30)}\nImprint and contact") for i in range(4)]
    got = run(spark, copies + rare + equal + others)
    assert all(got[i][0] == text and got[i][2] == 0 for i, text in rare + equal)
    assert all(got[i][0] == text.rsplit("\n", 1)[0] and got[i][2] == 1 for i, text in copies + others)


def test_odd_rows(spark):
    footer = "Sent from my phone"
    rows = [(i, f"{prose(rng(i), 30)}\n\n{footer}\r\n") for i in range(5)]
    odd = [(10, None), (11, ""), (12, "\n\n"), (13, prose(rng(9), 100_000)), (14, "a " * 5), (None, f"{prose(rng(77), 20)}\n{footer}")]
    got = run(spark, rows + odd + [rows[0]])
    assert got[0] == (rows[0][1].replace(footer + "\r\n", ""), 2, 1)
    assert got[10] == (None, 0, 0) and got[11] == ("", 0, 0) and got[12] == ("\n\n", 0, 0)
    assert got[13][2] == 0 and got[14][2] == 0 and got[None][2] == 1
    found = drop_recurring_lines(documents(spark, rows + [rows[0]]), P)
    assert found.count() == 6 and "key" in found.columns


def test_empty_table(spark):
    assert run(spark, []) == {}
