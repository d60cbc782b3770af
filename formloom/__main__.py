"""python -m formloom extract|convert|run SOURCE OUT [--model auto|all|NAME] [--dictionary FILE]: jobs from files to records and reports.
python -m formloom check|expand DICTIONARY OUT: a dictionary checked, or written anew with templates and aliases that it lacks."""

import argparse

from pyspark.sql import SparkSession

from formloom.plans import jobs


def main() -> None:
    p = argparse.ArgumentParser(prog="formloom", description=__doc__)
    p.add_argument("job", choices=("extract", "convert", "run", "check", "expand"))
    p.add_argument("source")
    p.add_argument("out")
    p.add_argument("--model", default="auto")
    p.add_argument("--dictionary")
    a = p.parse_args()
    spark = SparkSession.builder.appName("formloom").getOrCreate()
    if a.job == "extract":
        jobs.extract_folder(spark, a.source, a.out, a.model)
    elif a.job == "convert":
        jobs.convert_folder(spark, a.source, a.out, a.dictionary).show()
    elif a.job == "check":
        jobs.check_dictionary(spark, a.source, a.out).show(truncate=False)
    elif a.job == "expand":
        jobs.expand_dictionary(spark, a.source, a.out)
    else:
        jobs.run_all(spark, a.source, a.out, a.model, dictionary=a.dictionary).show()


if __name__ == "__main__":
    main()
