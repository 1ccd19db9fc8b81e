import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from chatmill.functions.dates import reformat_date
from chatmill.functions.prompts import schema_prompt
from chatmill.functions.targets import quote, strict_json, target_faults, with_ordered_target
from chatmill.operators.augment import with_variants
from chatmill.operators.pairing import pair_folders
from chatmill.plans.profiles import profile_dataset, valid_samples
from chatmill.schemas import PROFILE_FIELDS

NAMES = [f.name for f in PROFILE_FIELDS]
GOOD = {
    "name": 'Ann "A" \\ B', "gender": None, "email": "a/b@c", "address": "Line 1\nLine 2\t\x01\x1f", "date_of_birth": "5.3.1990",
    "nationality": "Österreich", "languages": ["Deutsch C1", None], "education": [], "skills": ["ü", 'q"'], "products": ["x"],
}


def test_quote_equals_python(column):
    cases = ["", "plain", 'a"b\\c/d', "\n\r\t\b\f", "".join(map(chr, range(1, 32))) + "\x7f", "äé   😀", "\\u000B \x0b"]
    assert column(quote, cases) == [json.dumps(c, ensure_ascii=False) for c in cases]


def test_strict_json_refuses_text_after_the_value(column):
    good = ['{"a": 1}', " [1] ", "null", '"x"', "1.5"]
    bad = ['{"a": 1} x', '{"a": 1}] x', '{"a": 1}} x', '{"a": 1}, {"b": 2}', '{"a": 1}, "b": 2', "", "{'a': 1}", '{"a": 1,}', "[1", None]
    assert column(lambda c: strict_json(c).isNotNull(), good + bad) == [True] * 5 + [False] * len(bad)


def test_faults(column):
    def faults(change=None, drop=None):
        record = {k: v for k, v in (GOOD | (change or {})).items() if k != drop}
        return json.dumps(record)

    cases = {
        faults(): [],
        faults({"languages": [1, {"a": 2}]}): [],
        faults(drop="name"): [("name", "missing")],
        faults({"skills": None}): [("skills", "not a list")],
        faults({"skills": "x"}): [("skills", "not a list")],
        faults({"email": 5}): [("email", "not a string")],
        faults({"email": ["x"]}): [("email", "not a string")],
        faults({"zip": 1, "age": 2}): [("zip", "unexpected"), ("age", "unexpected")],
        "[]": [(None, "not an object")],
        "null": [(None, "not an object")],
        "{bad": [(None, "unreadable")],
        faults() + " end": [(None, "unreadable")],
    }
    got = column(target_faults, list(cases))
    assert [[(f.field, f.fault) for f in row] for row in got] == list(cases.values())


def test_targets_that_only_python_reads(spark):
    whole = json.dumps(GOOD)
    rows = [("a", '{"name": 1, ' + whole[1:]), ("b", whole[:-1] + ', "email": NaN}'), ("c", json.dumps(GOOD | {"name": "x" * 21_000_000})), ("d", whole[:-1])]
    good, bad = valid_samples(spark.createDataFrame(rows, "sample string, json_text string"))
    assert sorted(r["sample"] for r in good.select("sample").collect()) == ["a", "c"]
    assert {r["sample"]: [(f.field, f.fault) for f in r.faults] for r in bad.collect()} == {"b": [("email", "not a string")], "d": [(None, "unreadable")]}


PLAIN = {"name": "Bo", "gender": None, "date_of_birth": "5.3.1990", "skills": ["ü", 'q"'], "education": []}
# (record, order, keys as they come out, lines of the printed text)
PRINTED = [
    (PLAIN, ["skills", "name"], ['{', '  "skills": [', '    "ü",', '    "q\\""', "  ],", '  "name": "Bo",', '  "gender": null,', '  "date_of_birth": "March 05, 1990",', '  "education": []', "}"]),
    (PLAIN, ["education", "date_of_birth", "gender", "name", "skills"], ["{", '  "education": [],', '  "date_of_birth": "March 05, 1990",', '  "gender": null,', '  "name": "Bo",', '  "skills": [', '    "ü",', '    "q\\""', "  ]", "}"]),
    ({"name": "x", "zip": {"a": [1, "ü"]}, "skills": []}, ["skills", "name"], ["{", '  "skills": [],', '  "name": "x",', '  "zip": {', '    "a": [', "      1,", '      "ü"', "    ]", "  }", "}"]),
    ({"languages": [1, 1.0, None, True, {"x": [1]}]}, NAMES, ["{", '  "languages": [', "    1,", "    1.0,", "    null,", "    true,", "    {", '      "x": [', "        1", "      ]", "    }", "  ]", "}"]),
    ({"date_of_birth": None}, NAMES, ["{", '  "date_of_birth": null', "}"]),
    ({}, NAMES, ["{}"]),
]


def test_ordered_target(spark):
    df = spark.createDataFrame([(i, json.dumps(r), o) for i, (r, o, _) in enumerate(PRINTED)], "i int, t string, o array<string>")
    got = with_ordered_target(df, "t", F.col("o"), F.lit(5)).orderBy("i").collect()
    assert [r.target.split("\n") for r in got] == [lines for _, _, lines in PRINTED]


def test_ordered_target_keeps_what_only_python_reads(spark):
    texts = ['{"name": "a", "skills": [], "name": "b", "date_of_birth": "5.3.1990"}', '{"name": NaN, "skills": []}']
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    got = with_ordered_target(df, "t", F.array(F.lit("skills"), F.lit("name")), F.lit(5)).orderBy("i").collect()
    assert [json.loads(r.target) for r in got][0] == {"skills": [], "name": "b", "date_of_birth": "March 05, 1990"}
    assert '"name": NaN' in got[1].target


def test_dates(column):
    values = ["15.03.1990", "5.3.1990", " 05.03.1990 ", "31.02.1990", "29.02.2000", "15.03.90", "1.1.19900", "001.1.1990", "unknown", None, "01.01.0000"]

    def expect(v, fmt):
        try:
            return datetime.strptime(v.strip(), "%d.%m.%Y").strftime(fmt)
        except (ValueError, AttributeError):
            return v

    for number, fmt in enumerate(["%d.%m.%Y", "%Y-%m-%d", "%d/%m/%Y", "%m/%d/%Y"]):
        assert column(lambda c, n=number: reformat_date(c, F.lit(n)), values) == [expect(v, fmt) for v in values]
    assert column(lambda c: reformat_date(c, F.lit(4)), values)[:2] == ["15. März 1990", "5. März 1990"]
    assert column(lambda c: reformat_date(c, F.lit(5)), values)[:2] == ["March 15, 1990", "March 05, 1990"]


def test_prompt(spark, column):
    text = spark.range(1).select(schema_prompt(["skills", "date_of_birth"], 3)).first()[0]
    lines = text.split("\n")
    assert lines[2].startswith("  skills         – ") and lines[3].startswith("  date_of_birth  – ")
    assert text.count("MM/DD/YYYY") == 2 and "{date}" not in text
    with pytest.raises(ValueError, match="unknown fields"):
        schema_prompt(["no_such_field"])
    with pytest.raises(Exception, match="unknown fields: other"):
        column(lambda c: schema_prompt(F.array(F.lit("name"), c)), ["other"])


def test_variants(spark):
    df = spark.createDataFrame([(f"s{i}", i % 2) for i in range(300)], "sample string, on int")
    rows = with_variants(df, "sample", F.when(F.col("on") == 1, 4).otherwise(0), seed=1).collect()
    assert len(rows) == 150 * 5 + 150
    for r in rows:
        assert sorted(r.field_order) == sorted(NAMES)
        assert (r.field_order, r.date_fmt) == (NAMES, 0) if r.variant == 0 else 1 <= r.date_fmt <= 5
    assert {r.date_fmt for r in rows if r.variant} == {1, 2, 3, 4, 5}
    assert len({tuple(r.field_order) for r in rows if r.variant}) > 500
    again = with_variants(df.repartition(3), "sample", F.when(F.col("on") == 1, 4).otherwise(0), seed=1)
    assert {(r.sample, r.variant, tuple(r.field_order), r.date_fmt) for r in rows} == {(r.sample, r.variant, tuple(r.field_order), r.date_fmt) for r in again.collect()}


def _folders(spark):
    texts = [("", f"s{i:02}", "b.md", f"  CV {i}\n") for i in range(20)] + [("", "s00", "a.md", "first by name"), ("", "only_text", "x.md", "x")]
    objects = [("", f"s{i:02}", "x.json", json.dumps(GOOD if i % 5 else {"name": "x"})) for i in range(20)] + [("", "only_json", "x.json", "{}")]
    return pair_folders(
        spark.createDataFrame(texts, "lang string, sample string, file string, cv_text string"),
        spark.createDataFrame(objects, "lang string, sample string, file string, json_text string"),
        ["lang", "sample"],
    )


def test_folder_pairs_and_dataset(spark):
    pairs, rejects = _folders(spark)
    first = pairs.filter("sample = 's00'").first()
    assert (first.cv_text, first.text_files, pairs.filter("sample = 's01'").first().cv_text) == ("first by name", 2, "CV 1")
    assert {(r["sample"], r.fault) for r in rejects.collect()} == {("only_text", "no json file"), ("only_json", "no text file")}
    assert (valid_samples(pairs)[0].count(), valid_samples(pairs)[1].count()) == (16, 4)
    train, evaluation = profile_dataset(pairs, share=0.25, augment=2, seed=3)
    t, e = train.collect(), evaluation.collect()
    keys = [{r["sample"] for r in rows} for rows in (t, e)]
    assert not keys[0] & keys[1] and len(keys[0] | keys[1]) == 16
    assert len(t) == 3 * len(keys[0]) and len(e) == len(keys[1]) and all(r.variant == 0 for r in e)
    everything, none = profile_dataset(pairs, augment=1)
    assert none is None and everything.count() == 32
    turns = everything.filter("sample = 's01' and variant = 0").first().conversations
    assert turns[1].content == "CV 1" and list(json.loads(turns[2].content).items()) == [(n, "05.03.1990" if n == "date_of_birth" else GOOD[n]) for n in NAMES]
