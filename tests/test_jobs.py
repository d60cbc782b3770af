"""Jobs from files to records and reports."""

import json

from formloom.plans import jobs

FORM = "PATIENT INFORMATION\nFirst Name: ____ Last Name: ____\nDate of Birth: __/__/____\nGender: [ ] Male [ ] Female\nSignature: ________ Date: ________"


def test_convert_folder(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text(FORM)
    (tmp_path / "in" / "b.txt").write_text("[NO TEXT LAYER] b")
    rates = jobs.convert_folder(spark, str(tmp_path / "in"), str(tmp_path / "out")).first()
    assert rates["documents"] == 1 and rates["matched"] >= 3
    told = spark.read.option("header", True).csv(str(tmp_path / "out" / "performance")).collect()
    assert {r["part"] for r in told} == {"dictionary", "overall", "rates", "best", "worst", "type", "section"}
    assert [float(r["value"]) for r in told if (r["part"], r["label"]) == ("overall", "documents")] == [1.0]
    rows = [json.loads(x) for f in (tmp_path / "out" / "records").glob("*.json") for x in f.read_text().splitlines()]
    assert len(rows) == 1 and rows[0]["doc_id"].endswith("a.txt")
    keys = [f["key"] for f in rows[0]["fields"]]
    assert {"first_name", "last_name", "date_of_birth"} <= set(keys) and len(keys) == len(set(keys))


def test_own_dictionary(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text("Patient Information\nShoe size: ____\nPet: ____\nFirst Name: ____")
    (tmp_path / "d.json").write_text(json.dumps({"basic": [{"key": "shoe_size", "title": "Size"}, {"key": "animal", "title": "Animal"}], "aliases": {"pet": "animal"}}))
    jobs.convert_folder(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "d.json"))
    got = {r["title"]: (r["key"], r["reused"]) for r in spark.read.parquet(str(tmp_path / "out" / "matched")).collect()}
    assert got == {"Shoe size": ("shoe_size", True), "Pet": ("animal", True), "First Name": ("first_name", False)}


def test_extraction_tries_models_in_order(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for n in ("good.pdf", "scan.pdf", "broken.docx", "left.doc"):
        (tmp_path / "in" / n).write_bytes(n.encode())
    prose = "The patient name and the date of birth are asked for on this page, with address and phone. " * 3

    def first(content):
        return prose if content == b"good.pdf" else "%%"

    def second(content):
        if content == b"good.pdf":
            raise AssertionError("was read well before")
        return prose if content == b"scan.pdf" else ""

    models = {"unstructured": first, "pdfplumber": second}
    got = {r["doc_id"].rsplit("/", 1)[1]: r for r in jobs.extract_folder(spark, str(tmp_path / "in"), str(tmp_path / "out"), "auto", models).collect()}
    assert set(got) == {"good.pdf", "scan.pdf", "broken.docx"}
    assert got["good.pdf"]["model"] == "unstructured" and got["scan.pdf"]["model"] == "pdfplumber" and got["scan.pdf"]["text"] == prose
    tried = spark.read.parquet(str(tmp_path / "out" / "attempts" / "1")).collect()
    assert len(tried) == 2 and all(r["success"] for r in tried)
    assert jobs.extract_folder(spark, str(tmp_path / "in"), str(tmp_path / "out2"), "all", models).count() == 6


def test_dictionary_is_checked_and_expanded(spark, tmp_path):
    given = {
        "_meta": {"name": "d", "version": "1.2"}, "odd": {"a": 1}, "aliases": {"pet": "animal", "current_medications": "own"},
        "basic": [
            {"key": "animal", "type": "input", "title": 'A "pet"', "control": {"input_type": "colour"}}, {"type": "input"}, {"key": "a", "type": "slider"}, {"key": "b"},
            {"key": "c", "type": "radio", "control": {"options": [{"name": "Yes", "value": "y"}, {"value": "n"}, {"name": "Perhaps"}]}, "if": [{"key": "animal"}, {"key": "nobody"}]},
        ],
    }
    (tmp_path / "d.json").write_text(json.dumps(given))
    found = {(r["category"], r["idx"], r["rule"]) for r in jobs.check_dictionary(spark, str(tmp_path / "d.json"), str(tmp_path / "checked")).collect()}
    assert found == {
        ("_file", None, "category_no_list"), ("basic", 0, "input_type_unusual"), ("basic", 1, "key_missing"), ("basic", 2, "type_unusual"), ("basic", 3, "type_missing"), ("basic", 4, "option_name_missing"),
        ("basic", 4, "option_value_missing"), ("basic", 4, "if_unknown"), *(("basic", i, "version_form") for i in range(5)),
    }
    made = json.loads(jobs.expand_dictionary(spark, str(tmp_path / "d.json"), str(tmp_path / "new")).first()["value"])
    assert made["basic"] == given["basic"] and made["odd"] == {"a": 1} and made["_meta"]["version"] == "1.2"  # no three numbers, so none is raised
    assert made["aliases"]["pet"] == "animal" and made["aliases"]["current_medications"] == "own" and made["aliases"]["under_doctors_care"] == "1.under_care"
    assert len(made["medical_conditions"][0]["control"]["options"]) == 45 and made["medical_conditions"][0]["control"]["options"][31] == {"name": "HIV/AIDS", "value": "hiv_aids"}
    (tmp_path / "e.json").write_text(json.dumps({"_meta": {"version": "2.9.4"}, "medical_conditions": [{"key": "mine", "type": "input"}]}))
    again = json.loads(jobs.expand_dictionary(spark, str(tmp_path / "e.json"), str(tmp_path / "newer")).first()["value"])
    assert again["_meta"]["version"] == "2.10.0" and again["medical_conditions"] == [{"key": "mine", "type": "input"}]
    (tmp_path / "f.json").write_text("no json")
    assert {r["rule"] for r in jobs.check_dictionary(spark, str(tmp_path / "f.json"), str(tmp_path / "f")).collect()} >= {"empty_or_no_json"}
