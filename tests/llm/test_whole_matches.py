"""Copies of benchmark items that a word of punctuation, dense slots, names or an inserted word once hid."""

import random
import time

import pytest

from tallysieve.llm import decontamination

from .conftest import make_text

ITEMS = {
    1: "12 + 15 = 27 , 27 - 9 = 18 , 18 + 4 = 22 , 22 - 7 = 15",
    2: "Which river , of all , crosses the old town ?",
    3: "On 3 May 1998 Anna Karl and Peter Smith paid 40 dollars to Maria Jones",
}
NAMED = {
    11: "What is the largest city near Rome today",
    12: "Alice has seven green apples and gives two of them away to her friend. How many apples are left in the basket",
    13: "In the small harbour near the old mill Mary sold fresh bread every single morning before the boats returned",
}


def found(items, text, **options):
    index = decontamination.Index(list(items.items()), **options)
    return {h[0]: h for h in decontamination.search_texts(index, decontamination.Coder(index.vocabulary), [text])[0]}


@pytest.mark.parametrize("item", ITEMS)
def test_verbatim_copies_with_punctuation_words_or_dense_slots(item):
    hits = found(ITEMS, f"some words before it\n{ITEMS[item]} and words behind it")
    assert set(hits) == {item} and hits[item][4] == 0


def test_dense_slots_with_other_values_are_no_copy():
    assert not found(ITEMS, "On 4 June 2001 Carl Otto and James Brown paid 55 euros to Laura Stone")
    assert not found(ITEMS, "13 + 16 = 29 , 29 - 8 = 21 , 21 + 5 = 26 , 26 - 3 = 23")


def test_punctuation_words_of_one_side_only():
    assert set(found(ITEMS, "say: Which river, of all — “ crosses the old town? indeed")) == {2}


@pytest.mark.parametrize("item,text", [
    (11, f"Exercise 4\n{NAMED[11]}"),
    (11, f"so {NAMED[11].lower()} they ask"),
    (12, NAMED[12].replace("Alice", "Bob")),
    (12, NAMED[12].replace("seven", "9").replace("two", "3").replace("Alice", "Bob")),
    (12, "Task 3 " + NAMED[12].lower().replace("seven", "8")),
    (13, NAMED[13].replace("Mary", "Mary Ann")),
    (13, NAMED[13].replace("fresh bread", "fresh white bread")),
])
def test_names_number_words_and_inserted_words(item, text):
    assert set(found(NAMED, text)) == {item}


def test_pieces_out_of_order_or_far_apart_do_not_add_up():
    words = NAMED[13].split()
    first, second = " ".join(words[:9]), " ".join(words[9:])
    assert set(found(NAMED, f"{first} indeed {second}")) == {13}
    assert not found(NAMED, f"{second} indeed {first}")
    assert not found(NAMED, first + " then" * 30 + f" {second}")


def test_short_items_hide_no_spread_windows():
    items = NAMED | {14: "four plain words here", 15: "red 5 dogs 6 saw cats 7 near old 8 barns 9 while hot winds 3 blew"}
    text = items[15].replace("5", "51").replace("9", "91")
    assert 15 in found(items, text)


def test_a_phrase_that_many_items_share_costs_little_and_hides_none(vocabulary):
    """Two thousand items begin alike; a text with the phrase alone holds none, one with a whole item holds that."""
    rng = random.Random(31)
    phrase = "Read the following short story and then answer the question below"
    items = {k: f"{phrase} {make_text(rng, 20, vocabulary)}" for k in range(2000)}
    index = decontamination.Index(list(items.items()))
    coder = decontamination.Coder(index.vocabulary)
    alone = " ".join(f"{phrase} {make_text(rng, 9, vocabulary)}" for _ in range(10))
    decontamination.search_texts(index, coder, [alone])
    began = time.process_time()
    assert decontamination.search_texts(index, coder, [alone]) == [[]]
    assert time.process_time() - began < 0.5
    assert [h[0] for h in decontamination.search_texts(index, coder, [f"so {items[77]} it is"])[0]] == [77]


def test_many_items_at_once_are_judged_as_one_by_one(vocabulary):
    """The comparison of all items at once gives up none that the search item by item finds."""
    rng = random.Random(32)
    few = vocabulary[:12]
    items = {k: make_text(rng, rng.randint(3, 24), few).title() if k % 3 else f"{make_text(rng, 8, few)} 3 km {make_text(rng, 8, few)}" for k in range(120)}
    texts = [f"{make_text(rng, 5, few)} {items[rng.randrange(120)]} {make_text(rng, 30, few)} {items[rng.randrange(120)].replace('3', '8')}" for _ in range(40)]
    together = decontamination.Index(list(items.items()))
    found = decontamination.search_texts(together, decontamination.Coder(together.vocabulary), texts)
    for text, hits in zip(texts, found):
        one_by_one = []
        for item in items.items():
            index = decontamination.Index([item])
            one_by_one += decontamination.search_texts(index, decontamination.Coder(index.vocabulary), [text])[0]
        assert sorted(h[0] for h in hits) == sorted(h[0] for h in one_by_one)
    assert sum(map(len, found)) > 40
