from __future__ import annotations

import plain

from tillwork.llm import quality_rules


def test_measures_as_by_brute_force(spark, corpus, prose):
    window = prose(6, 8)
    texts = [text for _, text in corpus] + [
        f"{window} {window}", f"{window} x {window} y {window}", "a a a a a a a a a a", "l\nl\n\n \nl\nm\nm", "## a|b <c> & $ % *", "\x0bA\x0cB\x85C\u00a0D",
        "ABC DEF", prose(8, 9) + "\n" + prose(8, 9),
    ]
    documents = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    columns = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    found = {row["doc_id"]: tuple(row[1:]) for row in quality_rules.ledger(documents).select("doc_id", *columns).collect()}
    assert found == {k: plain.rule_measures(text) for k, text in enumerate(texts)}


def test_policies_and_ablations_read_the_ledger_only(spark, corpus):
    rows = quality_rules.store(spark, spark.createDataFrame(corpus, "doc_id long, text string"))
    policy = quality_rules.VERSIONS["3"]
    failures = {row["doc_id"]: row["failures"] for row in rows.collect()}
    kept = {row["doc_id"] for row in rows.where(quality_rules.passes(policy)).collect()}
    assert kept == {doc_id for doc_id, bits in failures.items() if not bits & policy.mask}
    names = [name for name, _ in quality_rules.RULES]
    report = quality_rules.ablation(rows, policy).collect()
    assert [row["rule"] for row in report] == [name for name in names if name in policy.rules]
    for row in report:
        bit = 1 << names.index(row["rule"])
        assert row["n_failed"] == sum(bool(bits & bit) for bits in failures.values())
        assert row["n_kept"] == len(kept)
        assert row["n_kept_without"] == sum(not bits & policy.mask & ~bit for bits in failures.values())
    assert quality_rules.ablation(rows.limit(0), policy).count() == 0


def test_no_python_in_the_plan(spark, corpus):
    rows = quality_rules.ledger(spark.createDataFrame(corpus, "doc_id long, text string").coalesce(1))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
