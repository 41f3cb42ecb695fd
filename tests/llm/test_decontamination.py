from __future__ import annotations

import plain
import pytest

from tillwork.llm import decontamination


@pytest.fixture(scope="module")
def benchmark(prose):
    items = [(k, prose(2000 + k, 25)) for k in range(12)]
    return items + [(50, "Short Item, here"), (51, "single"), (52, None), (53, "..."), (None, prose(2100, 14)), (0, prose(2200, 12)), (54, "short item here")]


@pytest.fixture(scope="module")
def documents(prose, benchmark):
    found = [(0, None), (1, ""), (2, prose(1, 300))]
    for k, (_, text) in enumerate(benchmark[:12]):
        found.append((10 + k, prose(10 + k, 200) + " " + ", ".join(text.upper().split()[3:17]) + ". " + prose(30 + k, 120)))
    found += [(40, "a short ITEM here and a Single one"), (41, benchmark[14][1]), (42, benchmark[3][1] + " " + benchmark[3][1]), (43, "x " * 5000)]
    return found + [(44, benchmark[5][1].rsplit(" ", 16)[0])]


def schema(df):
    return df.select("doc_id", "decontamination")


@pytest.mark.parametrize("block", [10**6, 300])
def test_hits_as_by_brute_force(spark, documents, benchmark, monkeypatch, block):
    monkeypatch.setattr(decontamination, "BLOCK_BYTES", block)
    marked = decontamination.mark(
        spark.createDataFrame(documents, "doc_id long, text string"), spark.createDataFrame(benchmark, "item_id long, text string")
    )
    found = {}
    for row in marked.collect():
        state = row["decontamination"]
        hits, items = len(state["hits"]) // 16, state["items"]
        found[row["doc_id"]] = state["n_words"], hits, len(items), plain.sha(",".join(items)), hits > 0
    assert found == plain.contamination(documents, benchmark)


def test_removal_leaves_no_window_and_keeps_clean_texts(spark, documents, benchmark):
    marked = decontamination.mark(
        spark.createDataFrame(documents, "doc_id long, text string"), spark.createDataFrame(benchmark, "item_id long, text string")
    )
    kept = {row["doc_id"]: row["text"] for row in decontamination.remove_spans(marked).collect()}
    before = plain.contamination(documents, benchmark)
    for doc_id, text in documents:
        words, hits, *_ = before[doc_id]
        assert (doc_id in kept) == (2 * hits <= words)
        if not hits:
            assert kept[doc_id] == text
    assert not any(hit for *_, hit in plain.contamination(kept.items(), benchmark).values())


def test_empty_benchmark_leaves_all_clean(spark, documents):
    marked = decontamination.mark(
        spark.createDataFrame(documents, "doc_id long, text string"), spark.createDataFrame([], "item_id long, text string")
    )
    assert decontamination.remove_spans(marked.limit(0)).count() == 0
    assert decontamination.op3  # the registered form is tested with the edge cases
