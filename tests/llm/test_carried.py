"""Operators with broadcast models run where executors do not have the package."""

from tests.llm.foreign import run_elsewhere

DOCS = """
words = "alpha beta gamma delta epsilon zeta eta theta".split()
rows = [(i, " ".join(words[(i * k) % 8] for k in range(1, 30)), "s") for i in range(60)]
docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
"""


def test_language_model():
    run_elsewhere(DOCS + """
from pyspark.sql import functions as F
from hazardmarts.llm import lm
assert lm.score(docs, F.col("doc_id") % 7 == 2).where("score < 0").count() == 60
""")


def test_toxicity():
    run_elsewhere(DOCS + """
from hazardmarts.llm import toxicity
toxic = spark.createDataFrame([(100 + i, f"you are a stupid idiot number {i} and worthless", "s") for i in range(40)], docs.schema)
both = docs.unionByName(toxic)
labels = both.selectExpr("doc_id", "cast(doc_id >= 100 as int) as toxic", "1 as quality")
assert toxicity.score(both, toxicity.train(both, labels)).count() == 100
""")


def test_decontamination():
    run_elsewhere(DOCS + """
from hazardmarts.llm import decontam
items = spark.createDataFrame([(1, rows[3][1])], "item_id long, text string")
assert decontam.contaminated(docs, items).where("doc_id = 3").count() == 1
assert decontam.clean_rows(docs, items).where("doc_id = 3").count() == 0
""")
