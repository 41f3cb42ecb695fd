from __future__ import annotations

import random

import plain
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tillwork.llm import pii

PARTS = ["a", "b.c", "@", ".", "1", "22", "255", "256", " ", "-", "+", "(", ")", "_", "%", "4111111111111111", "é", "x@y.z", "1.2.3.4", "\n", "0000"]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(PARTS), max_size=14))
def test_plain_spans_follow_the_patterns(parts):
    text = "".join(parts)
    assert pii.plain_spans(text) == plain.personal_data(text)


@pytest.mark.parametrize(
    ("text", "kind", "shown"),
    [
        ("mail john (at) example (dot) com now", "email", "john (at) example (dot) com"),
        ("john at example dot com", "email", "john at example dot com"),
        ("jo.hn [at] ex-ample [dot] co [dot] uk", "email", "jo.hn [at] ex-ample [dot] co [dot] uk"),
        ("host 10 dot 0 dot 0 dot 1 x", "ip", "10 dot 0 dot 0 dot 1"),
        ("call plus one five five five one two three four five six seven ok", "phone", "plus one five five five one two three four five six seven"),
        ("jo\u04bbn@\u0435xample.com", "email", "jo\u04bbn@\u0435xample.com"),
        ("\uff14111 1111 1111 111\uff11", "card", "\uff14111 1111 1111 111\uff11"),
        ("+1\u200b (555) 123\u20134567", "phone", "+1\u200b (555) 123\u20134567"),
        ("é a\uff20b\uff0ecom", "email", "a\uff20b\uff0ecom"),
    ],
)
def test_disguises_map_back_to_the_source(text, kind, shown):
    base, every = pii.find(text)
    added = [one for one in every if one not in base]
    assert [(k, text[a:b]) for k, a, b in added] == [(kind, shown)]
    assert pii.masked(text) == text.replace(shown, pii.MASKS[kind])


@pytest.mark.parametrize(
    ("text", "kind", "shown"),
    [
        ("write to john at example.com, please", "email", "john at example.com"),
        ("write to john at example.co.uk. Then", "email", "john at example.co.uk"),
        ("write to john at mail.example dot com", "email", "john at mail.example dot com"),
        ("escribe a juan arroba ejemplo punto com hoy", "email", "juan arroba ejemplo punto com"),
        ("juan [arroba] ejemplo.es hoy", "email", "juan [arroba] ejemplo.es"),
        ("jean arobase exemple point fr !", "email", "jean arobase exemple point fr"),
        ("hans at beispiel punkt de", "email", "hans at beispiel punkt de"),
        ("host one nine two dot one six eight dot one dot one x", "ip", "one nine two dot one six eight dot one dot one"),
        ("host 192 punto uno seis ocho punto 1 (dot) uno x", "ip", "192 punto uno seis ocho punto 1 (dot) uno"),
        ("call five five five two six one nine four now", "phone", "five five five two six one nine four"),
        ("call zéro six un deux neuf neuf quatre deux sept.", "phone", "zéro six un deux neuf neuf quatre deux sept"),
        ("+\u09e7 \u09eb\u09eb\u09eb \u09e7\u09e8\u09e9 \u09ea\u09eb\u09ec\u09ed", "phone", "+\u09e7 \u09eb\u09eb\u09eb \u09e7\u09e8\u09e9 \u09ea\u09eb\u09ec\u09ed"),
        ("\U0001d7ec\U0001d7ed.2.3.4", "ip", "\U0001d7ec\U0001d7ed.2.3.4"),
        ("x \U0001d423\U0001d428\U0001d421\U0001d427@example.com", "email", "\U0001d423\U0001d428\U0001d421\U0001d427@example.com"),
        ("é o\ufb03@example.com", "email", "o\ufb03@example.com"),
        ("\u24d9o@example\ufe52com", "email", "\u24d9o@example\ufe52com"),
    ],
)
def test_disguises_behind_the_gates(text, kind, shown):
    test_disguises_map_back_to_the_source(text, kind, shown)


@pytest.mark.parametrize(
    "text",
    [
        "look at example.com or visit us at example.com", "priced at 3.5 million", "see it at main.py", "he came at noon.In the end", "meet at www.example.com",
        "one two three four five six seven eight", "un point de vue", "una arroba de trigo", "punkt zwei dot drei", "12 m\u00b2 \u00bd",
    ],
)
def test_prose_near_the_gates_stays(text):
    test_plain_prose_stays(text)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["0", "1", "9", " ", "-", "+", "@", ".", "a", "(", "one ", "é", "\n"]), st.sampled_from([1, 1, 2, 3, 5_000, 6_000])), max_size=8))
def test_long_runs_of_anything(parts):
    text = "".join(one * count for one, count in parts)
    base, every = pii.find(text)
    assert base == plain.personal_data(text) and set(base) <= set(every)
    assert not plain.personal_data(pii.masked(text))


@pytest.mark.parametrize("digit", ["0", "7", "\uff10"])
def test_numbers_longer_than_int_reads(digit):
    for text in (digit * 5_000 + ".1.1.1", f"1.{digit * 9_000}.2.3", "+" + digit * 6_000, f"host {digit * 5_000} dot 1 dot 1 dot 1"):
        base, every = pii.find(text)
        assert base == plain.personal_data(text)
        assert pii.masked(text) is not None
    assert pii.find("0" * 5_000 + ".1.1.1")[0] == [("ip", 0, 5_006)]


def test_long_runs_of_blanks_take_no_longer():
    assert pii.find("a" + " " * 20_000 + "b dot c" + " " * 20_000 + "at x") == ([], [])


@pytest.mark.parametrize("text", ["the dot in the text at noon", "look at this", "1, 2, 3, 4, 5, 6, 7, 8", "un chat et un chien", "", None, "Привет, мир"])
def test_plain_prose_stays(text):
    assert pii.find(text) == ([], []) and pii.masked(text) == text


def test_base_spans_stay_and_masks_do_not_overlap():
    rng = random.Random(4)
    for _ in range(300):
        text = " ".join(rng.choice(["a@b.co", "x (at) y (dot) com", "1.2.3.4", "4111 1111 1111 1111", "+1 (555) 123-4567", "word", "\uff11"]) for _ in range(6))
        base, every = pii.find(text)
        assert base == plain.personal_data(text) and set(base) <= set(every)
        assert not plain.personal_data(pii.masked(text))


def test_masked_documents_keep_their_columns(spark):
    documents = spark.createDataFrame([(1, "x a@b.com", "s"), (2, None, "t"), (3, "clean", None)], "doc_id long, text string, spans string")
    found = sorted(tuple(row) for row in pii.mask(documents).collect())
    assert found == [(1, "x <EMAIL>", "s"), (2, None, "t"), (3, "clean", None)]
