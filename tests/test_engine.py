"""The engine's rules against small cases, and its queries against DuckDB."""

import json
import os
import types
import uuid

import duckdb
import pytest
from pyspark.sql import functions as F

from formloom.functions import fields, lines, questions, text
from formloom.functions.dialect import column
from formloom.operators import catalog, classifier, grids, records, splits
from formloom.operators import lines as line_operators
from formloom.plans import queries
from formloom.sources import files

SF = "/root/testdata/sf0.001"


def values(spark, rule, *texts, **options):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, x string")
    return [r[0] for r in rows.orderBy("i").select(column(rule, "x", **options)).collect()]


def test_normalisation(spark):
    assert values(spark, text.restore_ligatures, "oﬃce ﬁle") == ["office file"]
    assert values(spark, text.collapse_spaced, "H o w  d i d  y o u", "a note to all", "Form: N a m e  of a pet", "I a m") == ["How did you", "a note to all", "Form: Name of a pet", "I a m"]
    assert values(spark, text.fix_phones, "(55O) 123-4567") == ["(550) 123-4567"]
    assert values(spark, text.clean_option, "Blood Blood Transfusion", "AIDS/HIV") == ["Blood Transfusion", "AIDS/HIV"]
    assert values(spark, text.slugify, "First Name", "", "2nd visit", "x" * 80) == ["first_name", "q", "q_2nd_visit", "x" * 64]
    assert values(spark, text.section_name, "PATIENT INFORMATION", "SIGNATURE", "Misc") == ["Patient Information", "Signature", "General"]
    assert values(spark, text.match_text, "Birth Date", "SSN #") == ["dob", "ssn"]


def test_predicates(spark):
    assert values(spark, lines.is_heading, "Medical History", "First Name:", "[ ] Yes", "What now?") == [True, False, False, False]
    assert values(spark, lines.weak_label, "", "Do you smoke?", "[ ] Yes", "Name:", "____________") == ["noise", "question", "option", "field_label", "value"]
    assert values(spark, lines.is_metadata, "F16015_REV_E", "All rights reserved", "Age") == [True, True, False]
    assert values(spark, fields.input_type, "First Name", "Home phone", "SSN", "Colour") == ["name", "phone", "ssn", "text"]
    assert values(spark, lines.is_valid_key, "a_1", "1a", "A") == [True, False, False]


def told_section(d, x):
    return fields.told_section(d, x, "''")


# FIXTURES.md, section B: literal cases with one that isn't, each written by hand
CASES = [
    (text.clean_checkboxes, {"[x] Yes": " [x] Yes", "[ X ] a": " [x] a", "Yes]No": "Yes [ ] No", "[J a": "[J a"}),
    (text.fix_terms, {"hypertens1on 3mail": "hypertension email", "Medication and teeth": "Medication and teeth", "card1ovascular anathesia": "cardiovascular anesthesia", "medicat1ons": "medications"}),
    (text.fix_label_characters, {"bir thdate nod ental": "birthdate no dental", "hearaboutus": "hear about us", "Address": "Address"}),
    (splits.field_parts, {"Name: ____ Sex: M or F Age: ____": ["Name: ____", "Sex: M or F", "Age: ____"], "Insurance ID # ____ SSN ____": ["Insurance ID Number: ____", "SSN: ____"], "Height: ____ Marital Status: [ ] Single [ ] Married": ["Height: ____", "Marital Status: [ ] Single [ ] Married"], "Name ____  City ____": ["Name ____", "City ____"], "Gender: [ ] M [ ] F": ["Gender: [ ] M [ ] F"]}),
    (told_section, {"Name and address": "Patient Information", "Heart surgery": "Medical History", "Crown of a tooth": "Dental History", "Colour": None}),
    (text.fix_phones, {"(55O) 123-4567": "(550) 123-4567", "call 5I5-l23-45O7 now": "call 515-123-4507 now", "Oil 12": "Oil 12"}),
    (text.fix_dates, {"on 1I2I2020": "on 1/2/2020", "O1/l2/2O20": "01/12/2020", "II/IV": "II/IV"}),
    (text.normalize_glyphs, {"☐ a": "[ ]  a", "☑ b": "[x]  b", "! c": "[ ] c", "wow!": "wow!"}),
    (text.separate_blanks, {"Name____": "Name: ___", "no blank": "no blank"}),
    (text.clean_title, {"[ ] Name: ____": "Name", "DOB: / /": "DOB", "a - b": "a - b"}),
    (text.slugify, {"First Name": "first_name", "Date of Birth": "date_of_birth"}),
    (text.match_text, {"Date of Birth": "dob", "E-Mail": "email", "Zip Code": "zipcode", "Colour": "colour"}),
    (text.section_name, {"PATIENT INFORMATION": "Patient Information", "SIGNATURE": "Signature", "Weather": "General"}),
    (text.clean_option, {"Blood Blood Transfusion": "Blood Transfusion", "AIDS/HIV": "AIDS/HIV", "Arthritis rheurnatism": "Arthritis Rheumatism"}),
    (lines.is_numbered_item, {"(iv) Pay": True, "2. Read": True, "2 Read": False}),
    (lines.is_instruction, {"Your escort must stay for the whole visit": True, "This consent form should be read in full": True, "Your name": False}),
    (lines.is_metadata, {"F16015_REV_E": True, "www.smile.com": True, "Age": False}),
    (lines.is_consent_heading, {"Informed Consent": True, "Name": False}),
    (lines.is_risk_item, {"Bleeding of the gums.": True, "First Name": False}),
    (lines.is_signature, {"Signature:": True, "Assigned to": False}),
    (lines.is_tabulated_signature, {"Name\tSignature\tDate": True, "Name\tAge": False}),
    (lines.has_orphan_boxes, {"[ ]   [ ]  [ ]": True, "[ ] Yes [ ] No": False}),
    (lines.is_other_specify, {"Other": True, "if other, list": True, "Mother": False}),
    (lines.is_underline, {"-----": True, "-- a": False}),
    (fields.input_type, {"First Name": "name", "SSN": "ssn", "Zip": "zip", "Colour": "text"}),
    (fields.option_value, {"Yes": "true", "no": "false", "Heart Disease": "heart_disease"}),
    (fields.clean_overflow, {"Mobile Phone": "Mobile Phone", "Reason for your visit today Date": "Reason for your visit today"}),
    (questions.sex_gender, {"Sex [ ] Male [ ] Female     City [ ] A": "Sex [ ] Male [ ] Female", "Gender: M or F Age": "Gender: M or F", "Age": ""}),
    (questions.marital_status, {"x Circle one: Single / Married": "Circle one: Single / Married", "Status": ""}),
    (questions.preferred_contact, {"Preferred contact method [ ] Phone [ ] Mail": "Preferred contact method [ ] Phone [ ] Mail", "Preferred contact method [ ] Phone": ""}),
    (questions.should_split, {"A: __ B: __": True, "Sex: [ ] Male [ ] Female Other:": False, "Name": False}),
    (questions.conditional_parts, {"Are you a student? If a minor: Mother DOB    Father DOB": ["Are you a student?", "Mother DOB", "Father DOB"], "Pain? [ ] Yes [ ] No If yes, please explain: __": ["Pain? [ ] Yes [ ] No If yes, please explain: __"]}),
    (questions.compound_label, {"Apt# State": ["Apt#", "State"], "AptState": ["Apt", "State"], "First Name": ["First Name"]}),
    (questions.compound_fields, {"First Name: ____ Last Name: ____ City:": ["First Name: ____", "Last Name: ____", "City: ___"], "Phone: ____": ["Phone: ____"]}),
    (questions.boxed_parts, {"Sex [ ] M [ ] F     Married [ ] Y [ ] N": ["Sex [ ] M [ ] F", "Married [ ] Y [ ] N"], "Sex [ ] M": ["Sex [ ] M"]}),
    (questions.bullet_option, {"- Latex": "Latex", "[ ] yes": "Yes", "[ ] a [ ] b": None, "Latex": None}),
    (questions.spaced_labels, {"Patient Signature            Date": ["Patient Signature", "Date"], "Signature Date": []}),
    (questions.inline_box_text, {"[ ] Yes, send me text alerts": "Yes, send me text alerts", "[ ] Yes": None}),
    (questions.id_and_ssn, {"Member ID # and SSN": ["insurance_id_number", "ssn"], "Member ID": []}),
    (questions.is_condition, {"High Blood Pressure": True, "Epilepsy": True, "Telephone": False}),
    (splits.subfields, {"Phone: Mobile _ Home _ Work _": ["Mobile Phone", "Home Phone", "Work Phone"], "Phone: ____": [], "Phone: 555-1234": []}),
    (splits.yes_no_prompts, {"Do you smoke? [ ] Yes [ ] No": ["Do you smoke?"], "Name": []}),
    (splits.question_parts, {"Sex? [ ] M     Age? [ ] 18": ["Sex? [ ] M", "Age? [ ] 18"]}),
    (splits.slash_parts, {"Apt/Unit/Suite____": ["Apt", "Unit", "Suite"], "Apt____": []}),
    (splits.inline_choices, {"Smoker? (Y or N)": ["Yes", "No"], "M/F": ["Male", "Female"], "circle one: a / b": ["a", "b"], "Smoker": []}),
    (splits.options, {" ".join(f"[ ] o{i}" for i in range(14)): [f"o{i}" for i in range(14)]}),
    (splits.tab_parts, {"a\t b": ["a", "b"]}),
    (grids.is_header, {"Appearance     Function     Habits": True, "[ ] A     [ ] B": False, "one two": False}),
]


@pytest.mark.parametrize("rule,cases", CASES, ids=[r.__name__ for r, _ in CASES])
def test_cases(spark, rule, cases):
    assert values(spark, rule, *cases) == list(cases.values())


def of_lines(spark, make, *docs):
    """Rows of an operator over the lines of small documents."""
    view = "_case_" + uuid.uuid4().hex
    spark.createDataFrame([(i, n, x) for i, t in enumerate(docs) for n, x in enumerate(t.split("\n"))], "doc_id long, pos long, line string").createOrReplaceTempView(view)
    return spark.sql(make(queries.SPARK, f"SELECT * FROM {view}")).collect()


def test_operators_on_lines(spark):
    wrapped = lambda t: [r["line"] for r in sorted(of_lines(spark, line_operators.soft_wraps, t), key=lambda r: r["pos"])]
    assert wrapped("such as Actonel/\nother medications") == ["such as Actonel/ other medications"]
    assert wrapped("What now?\nWhat then?") == ["What now?", "What then?"] and len(wrapped("a\n\nb")) == 3 and len(wrapped("Text\n[ ] Option")) == 2
    gathered = [r["line"] for r in of_lines(spark, line_operators.gathered_options, "Allergic to?\n[ ] Latex\n- Sulfa\n[x] Iodine")]
    assert gathered == ["Allergic to? [ ] Latex [ ] Sulfa [x] Iodine"]
    prose = "Please read this long line of text before you begin to write here\nIt has eight words or more as well in it\n" + "text of some kind\n" * 30
    form = prose + "Name: ____\nCity: ____\nAge: ____\nEmail: ____"
    assert {"Name", "City", "Age", "Email"} <= {r["title"] for r in of_lines(spark, records.fields, form)}  # a form that prose leads keeps its fields
    sheet = "Welcome to us\nImportant: read\na\nb\nc\nColour: __"
    assert [r["doc_id"] for r in of_lines(spark, line_operators.information_sheets, form, sheet)] == [1] and not of_lines(spark, records.fields, sheet)
    kept = of_lines(spark, records.fields, "Do you have pain? [ ] Yes [ ] No If yes, please explain: ____")
    assert [(r["title"], r["options"], r["follow_up"]) for r in kept] == [("Do you have pain", "Yes|No", 1)]
    grid = "\n".join(("Appearance / Look     Function     Habits", "[ ] Worn              [ ] Jaw      [ ] Gum", "[ ] Old               [ ] Pain     [ ] Ice", "End"))
    tables = lambda op: lambda d, s: op(d, grids.table_lines(d, s))
    cells = {r["option"] for r in of_lines(spark, tables(grids.cells), grid)}
    assert cells == {"Appearance / Look - Worn", "Function - Jaw", "Habits - Gum", "Appearance / Look - Old", "Function - Pain", "Habits - Ice"}
    assert [r["options"] for r in of_lines(spark, tables(grids.questions), grid)] and not of_lines(spark, tables(grids.cells), "A\n[ ] b [ ] c")


def test_records_with_control(spark):
    source = "SELECT 1 AS doc_id, 1 AS place, 'q' AS key, 'Do you smoke' AS title, 'General' AS section, 'radio' AS type, 'text' AS input_type, 2 AS n_options, 'Yes|It \"depends\"' AS options, 1 AS follow_up, '' AS html, cast(NULL as bigint) AS parent, '' AS answer, '' AS hint, '' AS multi, '' AS needs"
    rows = sorted(spark.sql(records.records(queries.SPARK, source)).collect(), key=lambda r: r["k"])
    assert json.loads(rows[0]["control"]) == {"options": [{"name": "Yes", "value": True}, {"name": 'It "depends"', "value": "it_depends"}], "multi": False}
    assert (rows[1]["key"], rows[1]["title"], json.loads(rows[1]["condition"])) == ("q_explanation", "Please explain", [{"key": "q", "value": "yes"}])


def test_matching(spark):
    rows = [(1, i, 0, text_, text_, section, "") for i, (text_, section) in enumerate([("first_name", "Patient Information"), ("Date of Birth", "Patient Information"), ("Cell Phone", "Patient Information"), ("Your Policy Number please", "Insurance"), ("Your Policy Number please", "General"), ("Are you taking medications", "Medical History"), ("Weather", "General")])]
    fields_ = spark.createDataFrame(rows, "doc_id int, pos int, sub int, key string, title string, section string, options string")
    fields_.createOrReplaceTempView("_match")
    got = {r["pos"]: (r["t_key"], r["reason"]) for r in spark.sql(catalog.match(queries.SPARK, catalog.best(queries.SPARK, "SELECT * FROM _match"))).collect()}
    assert got == {0: ("first_name", "key_exact"), 1: ("date_of_birth", "title_exact"), 2: ("mobile_phone", "alias_exact"), 3: ("insurance_id_number", "alias_contains"), 4: (None, None), 5: ("taking_medications", "fuzzy"), 6: (None, None)}
    view = "_smart"
    fields_.createOrReplaceTempView(view)
    smart = {r["title"]: r["t_key"] for r in spark.sql(catalog.smart(queries.SPARK, f"SELECT title, section FROM {view}")).collect()}
    assert smart["Cell Phone"] == "mobile_phone" and "Weather" not in smart


def test_plans_read_a_source_once(spark):
    queries.views(spark, SF) if os.path.isdir(SF) else pytest.skip("no test data")
    for name, most in (("fields", 1), ("template_merge", 1), ("violations", 1), ("stats", 1), ("improvement", 1), ("parity", 2)):
        plan = spark.sql(queries.RULES[name](queries.SPARK))._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("c_custkey#") and sum("Relation [" in x and "c_custkey" in x for x in plan.splitlines()) <= most, name


def test_classifier(spark, tmp_path):
    rows = [(i, j, t, "", "", 3) for i in range(30) for j, t in enumerate(("Name:", "Do you smoke?", "[ ] Yes"))]
    samples = classifier.labelled(spark.createDataFrame(rows, "doc_id long, pos int, line string, before string, following string, total int"))
    model = classifier.initialize(samples, str(tmp_path / "m"), trees=3, depth=3)
    again = classifier.initialize(samples, str(tmp_path / "m"))  # loaded, not trained
    assert sorted(map(tuple, classifier.predict(model, samples).collect())) == sorted(map(tuple, classifier.predict(again, samples).collect()))
    folds = classifier.cross_validate(samples, folds=2, trees=3, depth=3).collect()
    assert sum(r["n"] for r in folds) == 90 and all(r["accuracy"] > 0.9 for r in folds)


def test_extractors(monkeypatch):
    """Optional libraries, by stand-ins: strategies in turn, tables by rows."""
    tried = []

    def partition(file, strategy):
        tried.append(strategy)
        if strategy == "hi_res":
            raise RuntimeError("no model")
        meta = types.SimpleNamespace(text_as_html="<table><tr><td>a</td><td> b </td></tr><tr><th>c</th></tr></table>")
        return [types.SimpleNamespace(metadata=meta), "text"] if strategy == "ocr_only" else []

    monkeypatch.setattr(files.importlib, "import_module", lambda name: types.SimpleNamespace(partition=partition))
    assert files.EXTRACTORS["unstructured"](b"") == "a | b\nc\n\ntext" and tried == ["hi_res", "hi_res", "fast", "ocr_only"]
    fake = {"pdf2image": types.SimpleNamespace(convert_from_bytes=lambda c: ["p1", "p2"]), "pytesseract": types.SimpleNamespace(image_to_string=lambda p: p.upper())}
    monkeypatch.setattr(files.importlib, "import_module", fake.__getitem__)
    assert files.EXTRACTORS["tesseract"](b"") == "P1\nP2"


def test_files(spark, tmp_path):
    (tmp_path / "a.txt").write_text("Name: ____")
    (tmp_path / "b.txt").write_text("[NO TEXT LAYER] b")
    (tmp_path / "e.txt").write_bytes("Größe: ____".encode("latin-1"))
    (tmp_path / "c.pdf").write_bytes(b"no pdf")
    assert sorted(r["text"] for r in files.read_texts(spark, str(tmp_path)).collect()) == ["Größe: ____", "Name: ____"]
    row = files.extract(files.read_binaries(spark, str(tmp_path)), "none such").first()
    assert not row["success"] and "Unknown model" in row["error"]
    (tmp_path / "d.json").write_text('{"_meta": {"v": 1}, "basic": [{"key": "k", "title": "T"}], "aliases": {"a": "k"}}')
    known, aliases = files.read_catalog(spark, str(tmp_path / "d.json"))
    assert known.first()["key"] == "k" and aliases.first()["alias"] == "a"


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")
@pytest.mark.parametrize("name", ["quality_by_lang", "repeated_lines", "soft_wraps", "sections", "grid_columns", "weak_labels", "event_sessions", "orphan_orders", "event_json", "event_maps", "events_in_hour", "dictionary_violations", "slash_parts"])
def test_against_duckdb(spark, name):
    con = duckdb.connect()
    for t in queries.TABLES:
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    got = queries.queries()[name](spark, SF)
    want = con.sql(queries.oracle_sql()[name])
    assert sorted(got.columns) == sorted(want.columns)
    cols = sorted(want.columns)
    shown = lambda v: "~" if v is None else f"{float(v):.6g}" if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v)
    assert sorted(tuple(map(shown, r)) for r in got.select(*cols).collect()) == sorted(tuple(map(shown, r)) for r in want.select(*cols).fetchall())


def test_rules_need_no_python(spark):
    queries.views(spark, SF) if os.path.isdir(SF) else pytest.skip("no test data")
    plan = spark.sql(queries.RULES["quality_metrics"](queries.SPARK))._jdf.queryExecution().toString()
    assert "Python" not in plan and F
