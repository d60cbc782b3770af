"""Form-shaped documents derived from the relational tables, with the same SQL in both engines."""

from __future__ import annotations

from pyspark.sql import SparkSession

from ..functions.dialect import Dialect


# A grid as forms have it, and a question with conditions in two columns.
GRID = (
    "Appearance          Function            Habits", "[ ] Discolored      [ ] Grinding        [ ] Smoking", "[ ] Worn teeth      [ ] Headaches       [ ] Chewing", "[ ] Spaces          [ ] Jaw joint       [ ] Biting nails", "                    Other habits", "Please mark all",
)
SINGLE = ("Medical History", "Diabetes: ____", "Asthma: ____", "Stroke: ____", "Anemia: ____", "Glaucoma: ____", "Thyroid problems: ____")
CONDITIONS = (
    "Have you ever had any of the following", "[ ] Diabetes         [ ] Asthma", "[ ] Heart Disease    [ ] Stroke", "[ ] Kidney Disease   [ ] Ulcers", "[ ] Liver Disease    [ ] Cancer", "[ ] Anemia           [ ] Diabetes",
)


# Options three lines below their prompt, and follow-ups to three levels.
BELOW = ("Which of these apply to your teeth?", "(check all that apply)", "Please mark clearly", "[ ] Braces", "[ ] Dentures     [ ] Implants")
NESTED = ("Do you use tobacco? [ ] Yes [ ] No", "If yes, do you want to quit? [ ] Yes [ ] No", "If yes, when would you like to quit: ____", "If no, please explain: ____", "Do you drink? [ ] Yes [ ] No", "If no, please explain: ____")


# A grid whose rows were read as questions, fields without a heading of their own, and a block to sign.
BROKEN = (
    "Medical History", "Radiation Therapy Jaundice Jaw Joint Pain [ ] Radiation Therapy [ ] Jaundice [ ] Jaw Joint Pain [ ] Rheumatic Fever [ ] Scarlet Fever [ ] Shingles [ ] Sickle Cell",
    "Spina Bifida Stomach Disease Swelling Limbs [ ] Spina Bifida [ ] Stomach Disease [ ] Swelling Limbs [ ] Tonsillitis [ ] Tumors [ ] Yellow Jaundice [ ] Jaundice",
)
LOOSE = ("General", "Subscriber: ____", "Effective: ____", "Colour of eyes: ____", "Do you like your smile and teeth? [ ] Yes [ ] No", "Do you have any of these conditions? [ ] Diabetes [ ] Stroke", "Are you taking any medication now: ____")
TO_SIGN = ("Parent or guardian signature: ________", "Printed name: ________", "Today's date: ________", "Witness: ________")


# A sheet that only informs, though it speaks of names, dates and telephones.
SHEET = ("Welcome to the practice.", "Important: please read this.", "We keep the date of your last visit.", "Your name stays with us, and so does your signature.", "Phone: Mobile ____ Home ____", "Thank you")


def forms(d: Dialect) -> str:
    """doc_id, text: a form for each customer, with headings, labels, boxes, blanks, consent text, repeats and notices; for
    some a sheet that only informs."""
    q = d.lit
    lines = [
        q("123 N Main St, Springfield, IL 62704"), "CASE WHEN c_custkey % 4 = 0 THEN 'Smile Dental Care' END", "''", q("PATIENT INFORMATION"), f"concat('Name: ', c_name, {q('____')})",
        q("Phone: Mobile ____ Home ____ Work ____"), q("First Name: ____ Last Name: ____ Zip Code: ____"), q("Gender: [ ] Male [ ] Female"), "concat('Segment: [ ] ', c_mktsegment, ' [ ] OTHER')", q("Date of Birth: __/__/____"), "'Page 1'", "''",
        q("Insurance"), "CASE WHEN c_custkey % 3 = 0 THEN 'Secondary Insurance' ELSE 'Primary Insurance' END", q("Policy Number ______"), "concat('Country: ', n_name)", "'Page 1'", "''",
        q("Medical History"), q("Are you taking medications such as Fosamax/"), q("other drugs daily? [ ] Yes [ ] No"), "CASE WHEN c_acctbal < 0 THEN 'Do you have any of the following? [ ] Diabetes [ ] Asthma [ ] Heart Heart Disease' END",
        q("H o w  d i d  y o u"), q("ﬁll1ng and ph0ne number (55O) 123-4567 since 1I2I2020"), q("Oifice Yes]No [J maybe"), "'Comments:'", "'Page 1'", "''",
        q("I understand that treatment may result in swelling and possible complications. I hereby consent."), "CASE WHEN c_custkey % 2 = 0 THEN 'By signing below I acknowledge that I have read the possible risks of treatment and may include pain.' END",
        q("Bleeding of the gums."), q("Pain or discomfort."), "concat('Form F', cast(16000 + c_custkey as varchar(10)), '_REV_A all rights reserved')", q("Patient name (please print)\tSignature of guardian\tDate").replace("\\t", "\t"),
        q("Apt/Unit/Suite ____"), q("Are you a smoker? (Y or N)"), q("Circle one: Single / Married / Widowed"), q("[ ]      [ ]      [ ]"), q("Aspirin      Penicillin      Latex"),
        q("Are you allergic to any of the following?"), q("[ ] Codeine"), q("[x] Sulfa Drugs"), q("[ ] Local Anesthesia Other Metals"), q("Sex [ ] Male [ ] Female     Marital Status [ ] Single [ ] Married"),
        q("What is your preferred method of contact? [ ] Mobile [ ] E-mail"), q("How did you hear about us? [ ] Friend [ ] Internet"), q("How did you hear about us (other)? [ ] Radio [ ] Friend"),
        q("Do you have pain? [ ] Yes [ ] No If yes, please explain: ______"), q("Are you a student? Yes or No If patient is a minor: Mother DOB    Father DOB"), q("[ ] Yes, send me text alerts about visits"),
        q("Patient Signature                    Date"), "CASE WHEN c_custkey % 6 = 0 THEN 'Insurance ID # ____ SSN ____' END", q("AptState"), q("Do you react to any of the following? [ ] Aspirin [ ] Iodine"), q("Local Anesthesia Sulfa Drugs Other [ ] Local Anesthesia [ ] Sulfa Drugs [ ] Other"),
        "CASE WHEN c_custkey % 8 = 1 THEN concat_ws(chr(10), " + ", ".join(map(q, SINGLE)) + ") END", q("Allergies"), q("-----------"),
        "CASE WHEN c_custkey % 5 = 0 THEN concat_ws(chr(10), " + ", ".join(map(q, GRID)) + ") END", "CASE WHEN c_custkey % 7 = 0 THEN concat_ws(chr(10), " + ", ".join(map(q, CONDITIONS)) + ") END",
        "CASE WHEN c_custkey % 3 = 1 THEN concat_ws(chr(10), " + ", ".join(map(q, BELOW)) + ") END", "CASE WHEN c_custkey % 3 = 2 THEN concat_ws(chr(10), " + ", ".join(map(q, NESTED)) + ") END",
        "CASE WHEN c_custkey % 4 = 1 THEN concat_ws(chr(10), " + ", ".join(map(q, BROKEN)) + ") END", "CASE WHEN c_custkey % 4 = 2 THEN concat_ws(chr(10), " + ", ".join(map(q, LOOSE)) + ") END", "CASE WHEN c_custkey % 6 = 1 THEN concat_ws(chr(10), " + ", ".join(map(q, TO_SIGN)) + ") END",
        q("Signature: ________ Date: ________"),
    ]
    sheet = f"concat_ws(chr(10), {', '.join(map(q, SHEET))})"
    return f"SELECT c_custkey AS doc_id, CASE WHEN c_custkey % 9 = 4 THEN {sheet} ELSE concat_ws(chr(10), {', '.join(lines)}) END AS text FROM {customers(d)} JOIN nation ON c_nationkey = n_nationkey"


def customers(d: Dialect) -> str:
    """The customers, in Spark dealt by key before the forms are made of them: a file of one row group is one task, whatever
    the number of cores, and the lines of a form stay where it was dealt to."""
    if not d.spark:
        return "customer"
    n = int(SparkSession.active().conf.get("spark.sql.shuffle.partitions"))
    return f"(SELECT /*+ REPARTITION({n}, c_custkey) */ * FROM customer) customer"
