"""Records of JSON arrays read in splits, compared with a reader of the whole text."""
import glob
import json
import random

from pyspark.sql import functions as F

from conftest import rows
from test_csv_records import small_splits  # noqa: F401
from test_sources import put
from sellthrough import sources
from sellthrough.session import shared_folder
from sellthrough.sources.json_feed import NO_RECORDS, array_records, file_shapes, flat_records, json_chunks


def value(r):
    return r.choice([None, 1, 2.5, True, "", "a}b", 'q"{', "\\", '\\"}', "{[", "é\n}", {"x": {"y": "}"}}, [1, {"z": "]"}], "plain text"])


def test_records_over_many_splits(spark, tmp_path, small_splits):
    r, want = random.Random(3), {}
    for n in range(10):
        made = [{k: value(r) for k in r.sample(["a", "b c", 'd"', "e}"], r.randrange(0, 4))} for _ in range(r.choice([0, 1, 25]))]
        text = json.dumps(made, ensure_ascii=n % 2 == 0, indent=r.choice([None, 1]))
        want[put(tmp_path, f"f{n}.json", " \n" * (n % 3) + text + "\n" * (n % 2))] = made
    chunks = json_chunks(spark, list(want))
    assert chunks.select("source_file", "split").distinct().count() > 25
    got = {path: [] for path in want}
    for row in array_records(chunks).collect():
        assert row.problem is None
        got["file:/" + row.source_file.removeprefix("file:").lstrip("/")].append(row.record)

    def seen(records, loads):
        return sorted(json.dumps({k: loads(v) for k, v in x.items()}, sort_keys=True) for x in records)

    def back(v):
        try:
            return json.loads(v) if isinstance(v, str) and v[:1] in "[{" else str(v).lower() if isinstance(v, bool) else None if v is None else str(v)
        except ValueError:
            return v

    def plain(v):
        return v if isinstance(v, (dict, list)) else str(v).lower() if isinstance(v, bool) else None if v is None else str(v)

    for path, made in want.items():
        assert seen(got[path], back) == seen(made, plain), path


def test_broken_arrays_are_faults(spark, tmp_path):
    texts = {"a": '[{"style": "1"}, {"style": "2"}', "b": '[{"style": "1"} {"style": "2"}]', "c": '[{"style": "1"}, {"style": }]', "d": "[1, 2]", "e": '[{"style": "x}]',
             "f": "[]", "g": "", "h": '[{"style": "1"}, {"Style": "2"}]', "i": '[{"style": "ok"}]'}
    raw = sources.read_json_feed(spark, [put(tmp_path, f"{k}.json", v) for k, v in texts.items()])
    raw = raw.withColumn("f", F.regexp_extract("source_file", "([a-z]).json", 1))
    faulty = {x.f: x.layout_error for x in raw.filter("layout_error is not null").collect()}
    assert faulty == dict.fromkeys("abcde", NO_RECORDS) | {"h": "two columns mean style"}
    assert rows(raw.filter("f in ('f', 'g', 'i')"), "f", "style") == [("i", "ok")]


def test_flat_arrays_are_read_without_sums_over_their_text(spark, tmp_path, small_splits):
    r, flat, other = random.Random(5), [], []
    for n in range(8):
        made = [{k: r.choice([None, 1, True, "", "a, [b]", '"', "\\", "é", "plain text"]) for k in r.sample(["a", "b c", 'd"'], r.randrange(0, 4))} for _ in range(r.choice([1, 2, 40]))]
        flat.append(put(tmp_path, f"flat{n}.json", " \n" * (n % 3) + json.dumps(made, ensure_ascii=n % 2 == 0, indent=r.choice([None, 1])) + "\n" * (n % 2)))
    flat.append(put(tmp_path, "unread.json", '[{"a": 1}, {"a": x}, {"a": 3}]'))
    texts = ['[{"a": "}"}]', '[{"a": {"b": 1}}]', '[{"a": "1"}', '[{"a": "1"} {"a": "2"}]', '[{"a": "1"}] ]', '[{"a": "1"}], {"a": "2"}]', '[{"a": "1}, {"b": 2}]', "[]", "",
             '[{"a": "1"}][{"a": "2"}]', ', {"a": "1"}, {"a": "2"}]', '[{"a": "1"}, {\\"a": "2"}]', '{"a": "1"}', "ś[", '[{"a": "{"}, {"b": "["}, [{"c": 1}]']
    for n, text in enumerate(texts):
        other.append(put(tmp_path, f"other{n}.json", text))
    shapes = {x.source_file.rsplit("/", 1)[-1]: x for x in file_shapes(json_chunks(spark, flat + other)).collect()}
    assert all(shapes[f.rsplit("/", 1)[-1]].is_flat for f in flat)
    assert not any(x.is_flat for f, x in shapes.items() if f.startswith("other"))
    assert {f for f, x in shapes.items() if not x.is_array} == {"other10.json", "other12.json", "other13.json"}

    def records(found):
        return sorted((x.source_file, x.problem or "", json.dumps(x.record, sort_keys=True)) for x in found.collect())

    assert records(flat_records(json_chunks(spark, flat))) == records(array_records(json_chunks(spark, flat)))
    known = set(glob.glob(f"{shared_folder(spark)}/sellthrough/json-depth-*"))
    assert sources.read_json_feed(spark, flat).count() > 40
    assert set(glob.glob(f"{shared_folder(spark)}/sellthrough/json-depth-*")) == known
