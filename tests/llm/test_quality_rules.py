from __future__ import annotations

import re
from collections import Counter

import edge
import pytest
from conftest import SF
from pyspark.sql import functions as F

from wardlens.llm import quality_rules as rules


def statistics(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    counts = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = {j for i in range(len(words) - 2) if counts[tuple(words[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
    n, repeated = len(words), len(covered)
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    failed = n < 50 or 100 * repeated > 50 * n
    return n, sum(map(len, words)), symbols, len(lines) - len(set(lines)), repeated, failed


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


@pytest.mark.parametrize("source", ["fixture", "edge"])
def test_statistics(spark, source):
    if source == "fixture":
        docs, marks = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    else:
        docs, marks = edge.documents(spark, repeat=True, null_id=True), labels(spark, [(8, 1, 0), (8, 0, 1), (None, 0, 0), (15, None, 0)])
    got = rules.quality_rules(docs, marks).collect()
    want = sorted(str((r.doc_id, *statistics(r.text))) for r in docs.select("doc_id", "text").collect())
    assert sorted(str((r[0], *r[1:7])) for r in got) == want
    assert not any(r.kept and r.base_failed for r in got)


def test_empty_tables(spark):
    docs = edge.documents(spark)
    assert rules.quality_rules(edge.empty(spark), labels(spark, [])).count() == 0
    unlabelled = rules.quality_rules(docs, labels(spark, [])).collect()
    assert all(r.kept != r.base_failed for r in unlabelled)


@pytest.fixture(scope="module")
def marked(spark):
    """Texts of 60 to 90 words; those with symbols in half of the words, or in capitals, are bad."""
    text = F.concat_ws(
        " ",
        F.transform(
            F.sequence(F.lit(1), (F.pmod(F.xxhash64("doc_id"), F.lit(30)) + 60).cast("int")),
            lambda i: F.concat(
                F.when(F.col("doc_id") % 5 == 1, F.lit("WORD")).otherwise(F.lit("word")), (i * i).cast("string"),
                F.when((F.col("doc_id") % 5 == 0) & (i % 2 == 0), F.lit("###")).otherwise(F.lit("")),
            ),
        ),
    )
    docs = spark.range(900).select(F.col("id").alias("doc_id")).withColumn("text", text)
    marks = docs.select("doc_id", F.when(F.col("doc_id") % 5 < 2, 0).otherwise(1).alias("quality"))
    return docs, marks.where("doc_id % 3 = 0")


def test_learned_list_separates_bad_texts(marked):
    docs, marks = marked
    out = rules.quality_rules(docs, marks).collect()
    assert all(r.kept == (r.doc_id % 5 >= 2) for r in out)


def test_rules_on_bins_and_on_values_agree(marked):
    docs, marks = marked
    stats = rules.text_statistics(docs).join(marks.select("doc_id", (F.col("quality") == 0).alias("bad")), "doc_id")
    rows = stats.withColumn("grows", F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(2)) == 0)
    learned = rules.learn_rules(rows)
    assert 1 <= len(learned) <= rules.MAX_RULES and all(len(r) <= rules.MAX_CONDITIONS for r in learned)
    binned, _ = rules._bins(rows)
    caught = binned.where(rules._any(learned)).count()
    assert caught == rows.where(~rules.decision_list(learned)).count() == rows.where("bad").count()
    assert all(" >= " in str(c) or " < " in str(c) for rule in learned for c in rule)


def test_plan_is_native(spark):
    out = rules.text_statistics(spark.read.parquet(f"{SF}/documents.parquet"))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "InArrow" not in plan and "Exchange" not in plan
