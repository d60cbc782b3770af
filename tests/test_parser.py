"""The parser's folds, likeness of texts, overlays, joins and streams: literal cases, brute force and both engines."""

import datetime
import difflib
import itertools
import json
import os
import random
import uuid
from concurrent.futures import ThreadPoolExecutor

import duckdb
import pytest
from pyspark.sql import functions as F

from formloom.functions import similar
from formloom.operators import catalog, joins, parser, records
from formloom.plans import queries
from formloom.streaming import stream

SF = "/root/testdata/sf0.001"
SPARK, DUCK = queries.SPARK, queries.DUCK


def view(spark, rows, schema):
    name = "_case_" + uuid.uuid4().hex
    spark.createDataFrame(rows, schema).createOrReplaceTempView(name)
    return f"SELECT * FROM {name}"


def of_lines(spark, make, *docs):
    source = view(spark, [(i, n, x) for i, t in enumerate(docs) for n, x in enumerate(t.split("\n"))], "doc_id long, pos long, line string")
    return sorted(map(tuple, spark.sql(make(SPARK, source)).collect()))


def test_options_below_their_prompt(spark):
    far = "Name: ____\nWhich apply?\n(check all that apply)\n\nPlease mark clearly\n[ ] Braces\n[ ] Dentures  [ ] Implants\nZip: ____"
    got = of_lines(spark, parser.questions, far, "Which?\n(a)\n(b)\n(c)\n(d)\n[ ] x", "[ ] Alone\n- Other\n\n[ ] Apart", "Zip:\n[ ] Yes, send me text alerts", "", "Well?\nText\n[ ] Late\nSmoke? [ ] Yes [ ] No\n[ ] Odd")
    by = {i: [r[1:] for r in got if r[0] == i] for i in range(6)}
    assert (1, "Which apply? [ ] Braces [ ] Dentures  [ ] Implants", 6, 3) in by[0] and len(by[0]) == 6 and (7, "Zip: ____", 7, 1) in by[0]
    assert (0, "Which?", 0, 1) in by[1] and (5, "[ ] x", 5, 1) in by[1]  # beyond the reach
    assert (0, "[ ] Alone [ ] Other", 1, 2) in by[2] and (3, "[ ] Apart", 3, 1) in by[2]
    assert [r[1] for r in by[3]] == ["Zip:", "[ ] Yes, send me text alerts"] and by[4] == [(0, "", 0, 1)]
    assert [r[1] for r in by[5]] == ["Well?", "Text", "[ ] Late", "Smoke? [ ] Yes [ ] No", "[ ] Odd"]


FIELDS = "doc_id long, pos long, sub long, place long, title string, options string, key string, type string"


def test_follow_ups_and_keys_of_a_tree(spark):
    ask = [("Tobacco", "Yes|No"), ("If yes, quit?", "Yes|No"), ("If yes, when", ""), ("If no, why", ""), ("Name", ""), ("If yes, lost", ""), ("Drink", "Yes|No"), ("Please explain", "")]
    rows = [(1, i, 0, 10 - i, t, o, "k", "input") for i, (t, o) in enumerate(ask)] + [(2, 0, 0, 1, "If so, list", "", "a", "input"), (2, 1, 0, 2, "x", "", "a_2", "input"), (2, 2, 0, 3, "y", "", "a", "input"), (2, 3, 0, 4, "s", "", "signature", "signature"), (2, 4, 0, 5, "s", "", "signature", "signature")]
    source = view(spark, rows, FIELDS)
    got = {(r["doc_id"], r["place"]): r for r in spark.sql(parser.nested(SPARK, source, carry={"key": "string", "type": "string"})).collect()}
    assert [(got[1, 10 - i]["parent"], got[1, 10 - i]["depth"], got[1, 10 - i]["answer"]) for i in range(8)] == [(None, 0, ""), (10, 1, "yes"), (9, 2, "yes"), (9, 2, "no"), (None, 0, ""), (None, 0, ""), (None, 0, ""), (4, 1, "yes")]
    assert got[1, 8]["path"].startswith(got[1, 9]["path"] + ".")
    keys = spark.sql(parser.tree_keys(SPARK, parser.nested(SPARK, source, carry={"key": "string", "type": "string"}))).collect()
    of = {(r["doc_id"], r["place"]): r["key"] for r in keys}
    assert len({of[1, 10 - i] for i in range(8)}) == 8
    paths = sorted((got[1, p]["path"], of[1, p]) for p in range(3, 11))  # numbered in the tree's order, parents first
    assert [k for _, k in paths] == ["k", *(f"k_{n}" for n in range(2, 9))]
    assert [of[2, p] for p in (1, 2, 4, 5)] == ["a", "a_2", "signature", "signature"] and of[2, 3] not in ("a", "a_2")


def test_nesting_in_records(spark):
    text = "PATIENT INFORMATION\nDo you use tobacco? [ ] Yes [ ] No\nIf yes, do you want to quit? [ ] Yes [ ] No\nIf yes, when would you like to quit: ____\nWhich of these apply to your teeth?\n(check all that apply)\nPlease mark clearly\n[ ] Braces\n[ ] Dentures  [ ] Implants\nFirst Name: ____"
    source = view(spark, [(7, n, x) for n, x in enumerate(text.split("\n"))], "doc_id long, pos long, line string")
    converted = SPARK.stage(records.converted(SPARK, source))
    rows = {r["title"]: r for r in spark.sql(records.records(SPARK, catalog.merged(SPARK, converted, None, records.CONVERTED))).collect()}
    when = rows["If yes, when would you like to quit"]
    assert json.loads(when["condition"]) == [{"key": rows["If yes, do you want to quit"]["key"], "value": "yes"}]
    assert json.loads(rows["If yes, do you want to quit"]["condition"]) == [{"key": rows["Do you use tobacco"]["key"], "value": "yes"}]
    assert [o["name"] for o in json.loads(rows["Which of these apply to your teeth"]["control"])["options"]] == ["Braces", "Dentures", "Implants"]
    assert json.loads(rows["First Name"]["control"]) == {"input_type": "name"} and rows["First Name"]["condition"] is None


def test_signature_blocks(spark):
    got = of_lines(spark, parser.signature_blocks, "Parent signature: ____\nPrinted name: ____\n\nDate: ____\nx\nx\nx\nx\nDate: ____", "Date of Birth: ____\nSignature: ____", "Date: ____\na\nWitness: ____\nb\nSignature", "a")
    assert got == [(0, 0, 3, 4, True, False, "adult_with_guardian_details"), (2, 0, 4, 5, False, True, "adult_no_guardian_details")]


COLUMNS = "doc_id long, pos long, sub long, key string, title string, section string, type string, input_type string, n_options int, options string, follow_up int"


def a_field(pos, title, section="General", kind="input", options=""):
    return (1, pos, 0, title.lower().replace(" ", "_"), title, section, kind, "text", options.count("|") + 1 if options else 0, options, 0)


def test_sections_by_votes(spark):
    given = [a_field(0, "Policy holder"), a_field(1, "Effective"), a_field(2, "Nothing"), a_field(3, "Crown or filling"), a_field(4, "Teeth", "Dental History"), a_field(5, "Unknown"), a_field(9, "Other"), a_field(10, "Heart surgery")]
    got = {r["title"]: r["section"] for r in spark.sql(records.voted_sections(SPARK, view(spark, given, COLUMNS))).collect()}
    assert got == {"Policy holder": "Insurance", "Effective": "Insurance", "Nothing": "Dental History", "Crown or filling": "Dental History", "Teeth": "Dental History", "Unknown": "Medical History", "Other": "Medical History", "Heart surgery": "Medical History"}


def test_consolidation(spark):
    broken = ("Radiation Therapy Jaundice Jaw Joint Pain", "Medical History", "dropdown")
    given = [a_field(0, broken[0], *broken[1:], "Radiation|Jaundice|Jaw"), a_field(1, "Spina Bifida Stomach Disease", *broken[1:], "Jaundice|Spina|Tumors"), a_field(2, "Please mark Any Of These Things", *broken[1:], "a|b")]
    given += [a_field(3, "How did you hear about us", "General", "radio", "Friend"), a_field(4, "Name"), a_field(5, "How did you hear about us (other)", "General", "radio", "Radio|Friend")]
    got = {r["pos"]: r for r in spark.sql(records.consolidated(SPARK, view(spark, given, COLUMNS))).collect()}
    assert sorted(got) == [0, 2, 3, 4]
    assert (got[0]["key"], got[0]["options"], got[0]["n_options"]) == ("medical_conditions_consolidated", "Jaundice|Jaw|Radiation|Spina|Tumors", 5)
    assert got[3]["options"] == "Friend|Radio" and got[4]["title"] == "Name" and got[2]["n_options"] == 2


def test_overlay(spark):
    known = spark.createDataFrame([("size", "Shoe size", "Body", "input", "number", "In cm", None, '[{"key":"a","value":"b"}]', "", 0), ("pick", "Pick", None, "radio", None, None, "true", None, "A|B", 1), ("bare", "Bare", "X", None, None, None, None, None, "", 2), ("size", "Again", "Y", "date", None, None, None, None, "", 3)], "key string, title string, section string, type string, input_type string, hint string, multi string, condition string, options string, ord long")
    own = catalog.register(known, spark.createDataFrame([], "alias string, key string"))
    columns = f"{catalog.FIELD_COLUMNS}, type, input_type, n_options"
    rows = [(1, 0, 0, "size", "Your shoe size", "", "", "radio", "text", 0), (1, 1, 0, "pick__primary", "Choose", "Mine", "C", "dropdown", "text", 1), (1, 2, 0, "bare", "Bare", "Z", "D|E", "radio", "text", 2), (1, 3, 0, "none", "None", "Z", "", "input", "phone", 0)]
    source = view(spark, rows, "doc_id long, pos long, sub long, key string, title string, section string, options string, type string, input_type string, n_options int")
    got = {r["pos"]: r.asDict() for r in spark.sql(catalog.merged(SPARK, source, own, columns)).collect()}
    of = lambda pos, *names: tuple(got[pos][n] for n in names)
    names = ("key", "title", "section", "type", "input_type", "options", "n_options", "hint", "multi", "needs")
    assert of(0, *names) == ("size", "Your shoe size", "Body", "input", "number", "", 0, "In cm", "", '[{"key":"a","value":"b"}]')
    assert of(1, *names) == ("pick__primary", "Choose", "Mine", "radio", None, "A|B", 2, "", "true", "")
    assert of(2, *names) == ("bare", "Bare", "Z", "radio", "text", "D|E", 2, "", "", "") and of(3, "reused", "type", "input_type") == (False, "input", "phone")


def test_likeness(spark):
    r = random.Random(4)
    texts = ["".join(r.choices("abc d", k=r.randint(1, 14))) for _ in range(24)] + ["are you taking medications", "are you taking any medications", "aaaa", "ünd"]
    pairs = list(itertools.combinations(sorted(set(texts)), 2))
    got = {(x["a"], x["b"]): x["ratio"] for x in spark.sql(similar.ratios(SPARK, view(spark, pairs, "a string, b string"))).collect()}
    assert got.keys() == set(pairs) and all(abs(v - difflib.SequenceMatcher(None, a, b).ratio()) < 1e-9 for (a, b), v in got.items())
    words = sorted({w for t in texts for w in t.split()} | {"adress", "address", "relationship", "relationshp", "realtionship", "x" * 50, "x" * 49})
    close = {(x["text"], x["label"]) for x in spark.sql(similar.close_pairs(SPARK, view(spark, [(w,) for w in words], "text string"), view(spark, [(w,) for w in words], "label string"))).collect()}
    duck = duckdb.connect()
    duck.execute("create table w(x varchar)")
    duck.executemany("insert into w values (?)", [(w,) for w in words])
    brute = duck.sql("select a.x, b.x from w a, w b where levenshtein(a.x, b.x) <= 2 and 1 - (2 * levenshtein(a.x, b.x) - abs(length(a.x) - length(b.x))) / (length(a.x) + length(b.x))::double >= 0.85 and (a.x = b.x or length(a.x) + length(b.x) < 80)").fetchall()
    assert close == set(brute) and ("adress", "address") in close and ("relationshp", "relationship") in close
    fixed = {x["word"]: x["corrected"] for x in spark.sql(similar.corrected_words(SPARK, view(spark, [("Adress",), ("PHONNE",), ("medicaton",), ("zip",), ("house",), ("Name",)], "word string"))).collect()}
    assert fixed == {"Adress": "Address", "PHONNE": "PHONE", "medicaton": "medication"}


def test_overlap_join(spark):
    r = random.Random(6)
    at = lambda s: datetime.datetime(2024, 1, 1) + datetime.timedelta(seconds=s)
    rows = [(k, i, at(s), at(s + r.choice([0, 1, 500, 4000, 90_000]))) for i in range(120) for k, s in [(r.choice("ab"), r.choice([3600 * r.randint(0, 40), r.randint(0, 150_000)]))]] + [("a", 900, at(0), None), (None, 901, at(0), at(9)), ("b", 902, at(50), at(10))]
    df = spark.createDataFrame(rows, "k string, id int, start timestamp, end timestamp")
    got = sorted((x["id"], x["r_id"]) for x in joins.overlap_join(df, df, ["k"], seconds=3600).collect())
    assert got == sorted((a[1], b[1]) for a in rows for b in rows if a[0] and a[0] == b[0] and a[3] and b[3] and a[2] < a[3] and b[2] < b[3] and a[2] < b[3] and b[2] < a[3]) and len(got) > 300


def test_skewed_join_bounds_its_tasks(spark):
    rows = [("hot", i % 3, i) for i in range(6000)] + [(f"k{i % 50}", 1, i) for i in range(500)] + [("alone", 1, 1), (None, 1, 1)]
    big, small = spark.createDataFrame(rows, "k string, x int, y int"), spark.createDataFrame([("hot", 1), ("hot", 2), ("k1", 3), ("k2", 4), (None, 5)], "k string, v int")
    key = lambda r: tuple(map(str, r))
    for how in ("inner", "left"):
        got = joins.skewed_join(big, small, ["k"], per=500, how=how)
        assert got.columns == big.join(small, "k", how).columns
        assert sorted(map(tuple, got.collect()), key=key) == sorted(map(tuple, big.join(small, "k", how).collect()), key=key)
    parts = {r["k"]: r["_parts"] for r in joins.salts(big, ["k"], 500).collect()}
    assert parts == {"hot": 12}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = joins.skewed_join(big, small, ["k"], per=500)._jdf.queryExecution().toString()
        assert "hashpartitioning(k" in plan and "_salt" in plan
        dealt = big.withColumn("_salt", F.pmod(F.xxhash64(F.xxhash64("k", "x", "y"), F.monotonically_increasing_id()), F.lit(12))).filter("k = 'hot'").groupBy("_salt").count()
        assert dealt.agg(F.max("count")).first()[0] < 2 * 500  # a part holds a bounded share of the hot key
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_streams_with_late_rows(spark, tmp_path):
    at = lambda minute: datetime.datetime(2024, 1, 1) + datetime.timedelta(minutes=minute)
    schema = "event_id long, ts timestamp, user_id long, event_type string, value double"
    batches = [
        [(1, at(0), 1, "click", 1.0), (2, at(10), 1, "purchase", 1.0), (3, at(50), 1, "click", 1.0)],
        [(2, at(10), 1, "purchase", 1.0), (4, at(45), 1, "purchase", 1.0), (5, at(300), 2, "click", 1.0)],
        [(6, at(5), 1, "purchase", 9.0), (7, at(330), 2, "purchase", 1.0), (8, at(900), 3, "view", 1.0)],
    ]
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / "in" / f"part{i}"))
        for f in (tmp_path / "in" / f"part{i}").iterdir():
            os.utime(f, (1_700_000_000 + 60 * i,) * 2)  # the order in which they are read
    read = lambda: spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(str(tmp_path / "in"))
    table = spark.createDataFrame([r for b in batches for r in b], schema)
    got, told = stream.appended(read(), stream.distinct_events)
    assert sorted(r["event_id"] for r in got.collect()) == [1, 2, 3, 4, 5, 7, 8] and sum(t["dropped"] for t in told) == 1  # 6 came too late
    assert told[-1]["state"] < 7  # ids are forgotten
    got, told = stream.appended(read(), stream.closed_sessions)
    in_time = stream.closed_sessions(table.filter("event_id <> 6"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, in_time.collect())) and sum(t["dropped"] for t in told) == 1
    got, told = stream.appended(read(), stream.followed)
    # a join's watermark is that of its slower side, for which 6 is in time
    assert sorted(set(map(tuple, got.collect()))) == sorted(set(map(tuple, stream.followed(table).collect()))) == [(1, 1, 2), (1, 1, 4), (1, 1, 6), (2, 5, 7)]
    known = spark.createDataFrame([(1, "a"), (3, "c")], "id long, name string")
    got, _ = stream.appended(read(), lambda s: stream.with_known(s, known, "user_id", "id"))
    assert sorted((r["event_id"], r["name"] or "") for r in got.collect())[-1] == (8, "c") and got.count() == 9


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")
def test_every_query_against_duckdb(spark):
    """All queries with SQL, four at a time, on the smallest tables."""
    con = duckdb.connect()
    con.sql("set TimeZone = 'UTC'")
    for t in queries.TABLES:
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    known, sql = queries.queries(), queries.oracle_sql()
    shown = lambda v: "~" if v is None else f"{float(v):.6g}" if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v)

    def differs(name):
        try:
            got = known[name](spark, SF)
            want = con.cursor().sql(sql[name])
            cols = sorted(want.columns)
            if sorted(got.columns) != cols:
                return f"{name}: {sorted(got.columns)} {cols}"
            a = sorted(tuple(map(shown, r)) for r in got.select(*cols).collect())
            b = sorted(tuple(map(shown, r)) for r in want.select(*(f'"{c}"' for c in cols)).fetchall())
            return None if a == b else f"{name}: {len(a)} {len(b)} {sorted(set(a) - set(b))[:1]} {sorted(set(b) - set(a))[:1]}"
        except Exception as e:  # noqa: BLE001  all are told at the end
            return f"{name}: {str(e)[:300]}"

    with ThreadPoolExecutor(4) as pool:
        wrong = [x for x in pool.map(differs, sorted(sql)) if x]
    assert not wrong, "\n".join(wrong)
