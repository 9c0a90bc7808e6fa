"""Benchmark decontamination by canonical templates.

Words are stripped of punctuation and lower-cased, and words of punctuation alone are dropped; numbers (also in words),
units and names become typed placeholders. A capitalised word may be a name or not: windows are looked up with all of
them as names, with none, and with those inside sentences. Windows of a document's canonical words are looked up in the
hash table of the benchmark's windows. What is found names diagonals (the same shift between document and item), whose
windows are then compared word by word and must agree on their slots: each value of the item stands for one value of the
document and the other way round. Windows of several diagonals add up if they follow each other in document and item,
with at most a window's length between them. A document contains an item if the agreeing windows cover enough of its words.

Windows with changed slots need some plain words, so that placeholders alone never match; windows with fewer count if
they are verbatim. Items shorter than a window are one window.
NULL and empty texts contain nothing; NULL and empty items are contained nowhere. Repeated documents are judged row by
row, repeated items each give a hit. An empty benchmark or table gives no hits; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import texts, words_of

#: Words in a window, how many of them must be plain, and covered words that make a hit (or the whole item, if shorter).
WINDOW, PLAIN, COVERED = 8, 5, 13
#: Benchmark rows held in memory at once; a larger benchmark goes over the documents in several blocks.
BLOCK_ITEMS = 20_000
#: Words whose codes a task remembers.
MEMORY_WORDS = 300_000

# Unit words in singular and plural, and their short forms.
UNITS = frozenset(
    "meter meters metre metres kilometer kilometers kilometre kilometres centimeter centimeters mile miles foot feet inch "
    "inches yard yards gram grams kilogram kilograms pound pounds ounce ounces ton tons liter liters litre litres gallon "
    "gallons second seconds minute minutes hour hours day days week weeks month months year years dollar dollars cent cents "
    "euro euros percent degree degrees km cm mm kg mg ml mph kmh lb lbs oz ft min hr hrs sec".split()
)
NUMBER = re.compile(r"[-+~€$£]?\d[\d,.:/]*(?:st|nd|rd|th|%|°|[a-z]{1,3})?")
EDGES = "".join(map(chr, range(33, 48))) + ":;<=>?@[\\]^_`{|}~“”‘’«»…–—¿¡"
NUM, UNIT, NAME = "<number>", "<unit>", "<name>"
ONES = "one two three four five six seven eight nine".split()
TEENS = "ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen".split()
TENS = "twenty thirty forty fifty sixty seventy eighty ninety".split()
NUMBER_WORDS = {w: str(k) for k, w in enumerate(["zero", *ONES, *TEENS])} | {"hundred": "100", "thousand": "1000", "million": "1000000"}
for _k, _ten in enumerate(TENS, 2):
    NUMBER_WORDS |= {_ten: str(10 * _k)} | {f"{_ten}-{one}": str(10 * _k + n) for n, one in enumerate(ONES, 1)}
#: Capitalised words in a window of an item up to which every choice of names among them is in the table.
CHOICES = 3
HITS = "array<struct<item_id:bigint,n_windows:int,n_words:int,n_slots:int,n_changed:int>>"
FACTOR = np.uint64(0x9E3779B97F4A7C15)


def bare(word: str) -> str:
    return word.strip(EDGES)


def canonical(word: str) -> tuple[str, str | None, bool, bool]:
    """Literal form in lower case with numbers in digits (empty: punctuation alone), its placeholder if it is a number
    or unit, whether it may be a name, and whether it ends a sentence."""
    core = word if word.isalpha() else bare(word)
    ends = len(core) < len(word) and word.rstrip("\"'”’)»")[-1:] in tuple(".!?:")
    low = core.lower()
    if low in NUMBER_WORDS:
        return NUMBER_WORDS[low], NUM, False, ends
    if not core.isalpha() and NUMBER.fullmatch(low):
        return low, NUM, False, ends
    if low in UNITS:
        return low, UNIT, False, ends
    return low, None, len(core) > 1 and core[0].isupper() and core[1:].islower(), ends


def literal(word: bytes) -> str:
    return canonical(word.decode("utf-8", "replace"))[0]


@dataclass
class Codes:
    """Codes of the words that are not punctuation alone, and where these words are."""

    at: np.ndarray
    literal: np.ndarray
    #: Numbers and units as placeholders; capitalised words as names nowhere, within sentences, everywhere.
    unnamed: np.ndarray
    inside: np.ndarray
    named: np.ndarray

    def __len__(self) -> int:
        return len(self.at)

    def readings(self) -> list[np.ndarray]:
        return [self.named, self.inside, self.unnamed]


class Coder(dict):
    """Word -> code of its literal form (0: not in the vocabulary), times 32, plus its kind and marks."""

    def __init__(self, vocabulary: dict[str, int], grow: bool = False) -> None:
        super().__init__()
        self.vocabulary, self.grow = vocabulary, grow
        for form in (NUM, UNIT, NAME):
            vocabulary.setdefault(form, len(vocabulary) + 1)

    def __missing__(self, word: bytes) -> int:
        form, slot, name, ends = canonical(word.decode("utf-8", "replace"))
        if self.grow and form:
            self.vocabulary.setdefault(form, len(self.vocabulary) + 1)
        code = self.vocabulary.get(form, 0) * 32 + 16 * (slot == UNIT) + 8 * (slot == NUM) + 4 * (form != "") + 2 * name + ends
        if len(self) >= MEMORY_WORDS:
            self.clear()
        self[word] = code
        return code

    def codes(self, words: list[bytes], wanted: np.ndarray | None = None) -> Codes:
        """Of all words, or of those `wanted`: the others count as words that no item has."""
        if wanted is None:
            raw = np.fromiter(map(self.__getitem__, words), "int64", len(words))
        else:
            raw = np.full(len(words), 4)
            raw[wanted] = np.fromiter((self[words[k]] for k in np.flatnonzero(wanted).tolist()), "int64", np.count_nonzero(wanted))
        begins = np.ones(len(raw), bool)
        begins[1:] = raw[:-1] & 1
        at = np.flatnonzero(raw & 4)
        raw, begins = raw[at], begins[at]
        plain = np.where(raw & 8, self.vocabulary[NUM], np.where(raw & 16, self.vocabulary[UNIT], raw >> 5))
        name = raw & 2 > 0
        named = np.where(name, self.vocabulary[NAME], plain)
        return Codes(at, raw >> 5, plain, np.where(begins, plain, named), named)


def window_hashes(codes: np.ndarray, size: int) -> np.ndarray:
    out = np.zeros(len(codes) - size + 1, "uint64")
    for k in range(size):
        out = (out ^ codes[k : k + len(out)].astype("uint64")) * FACTOR
        out ^= out >> np.uint64(29)
    return out


SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
#: Letters and digits keep a random value, upper like lower case; other bytes are skipped.
VALUE = np.zeros(256, "uint64")
for _k, _byte in enumerate(b"abcdefghijklmnopqrstuvwxyz0123456789", 1):
    VALUE[_byte] = VALUE[bytes([_byte]).upper()[0]] = (_k * 0xBF58476D1CE4E5B9 + 0x94D049BB133111EB) % 2**64
SOLID = np.arange(256) >= 128  # letters, digits and bytes beyond ASCII
SOLID[VALUE > 0] = True
OPENS_SLOT = np.ones(256, bool)  # anything but a lower-case ASCII letter
OPENS_SLOT[97:123] = False
BASE, INVERSE = 0x100000001B3, pow(0x100000001B3, -1, 2**64)


def powers(base: int, count: int) -> np.ndarray:
    out = np.full(count, base, "uint64")
    out[:1] = 1
    return np.cumprod(out)


def word_hashes(body: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin, end and a hash of the ASCII letters and digits of each white-space word."""
    space = SPACE[body]
    edges = np.flatnonzero(np.diff(np.concatenate([[True], space, [True]])))
    begin, end = edges[::2], edges[1::2]
    values = VALUE[body]
    used = values > 0
    before = np.concatenate([[0], np.cumsum(used)])
    values = values[used]
    sums = np.concatenate([np.zeros(1, "uint64"), np.cumsum(values * powers(BASE, len(values)))])
    return begin, end, (sums[before[end]] - sums[before[begin]]) * powers(INVERSE, len(sums))[before[begin]]


def counts(flags: np.ndarray, size: int) -> np.ndarray:
    """How many of each window's flags are set."""
    sums = np.concatenate([[0], np.cumsum(flags)])
    return sums[size:] - sums[:-size]


class Index:
    """Hash tables of the benchmark's windows: sorted hashes with the item and position of each."""

    def __init__(self, items: list[tuple[int, str | None]], window: int = WINDOW, plain: int = PLAIN, covered: int = COVERED) -> None:
        self.window, self.plain, self.covered = window, plain, covered
        self.vocabulary: dict[str, int] = {}
        coder = Coder(self.vocabulary, grow=True)
        self.slots = np.array([self.vocabulary[x] for x in (NUM, UNIT, NAME)])
        self.items = []
        found = defaultdict(list)
        for item_id, text in items:
            words = words_of(text)
            codes = coder.codes(words)
            number = len(self.items)
            self.items.append((item_id, [literal(words[k]) for k in codes.at], codes))
            size = min(window, len(codes))
            if not size:
                continue
            for reading in self.variants(codes, size):
                hashes, enough, at = reading
                found[size, False].append((hashes[enough], np.full(enough.sum(), number), at[enough]))
            # What lacks plain words in any reading is found verbatim only.
            few = np.flatnonzero(counts(~self.is_slot(codes.unnamed), size) < min(plain, size))
            found[size, True].append((window_hashes(codes.literal, size)[few], np.full(len(few), number), few))
        self.tables = {}
        for key, rows in found.items():
            hashes, numbers, places = map(np.concatenate, zip(*rows))
            if len(hashes):
                order = np.lexsort((places, numbers, hashes))
                self.tables[key] = (hashes[order], numbers[order], places[order])

        # All items' codes one after another, to compare many items with a text at once.
        lengths = [len(codes) for *_, codes in self.items]
        self.begins = np.cumsum([0, *lengths])
        self.literals = np.concatenate([codes.literal for *_, codes in self.items] or [np.zeros(0, "int64")])
        self.names = np.concatenate([codes.named for *_, codes in self.items] or [np.zeros(0, "int64")])
        self.shortest = min((size for size, _ in self.tables), default=0)
        forms = " ".join(v for v in [*self.vocabulary, *NUMBER_WORDS] if v not in (NUM, UNIT, NAME)).encode("utf-8", "surrogatepass")
        self.plain_hashes = np.unique(word_hashes(np.frombuffer(forms, "uint8"))[2])
        units = " ".join([*UNITS, *NUMBER_WORDS]).encode()
        self.unit_hashes = np.unique(word_hashes(np.frombuffer(units, "uint8"))[2])

    def is_slot(self, codes: np.ndarray) -> np.ndarray:
        return (codes[..., None] == self.slots).any(-1)

    def variants(self, codes: Codes, size: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(hashes, whether there are enough plain words, positions) of the readings of an item's windows."""
        need, name = min(self.plain, size), codes.named != codes.unnamed
        everywhere = np.arange(len(codes) - size + 1)
        for k, reading in enumerate(codes.readings()):
            new = np.ones(len(everywhere), bool)
            for other in codes.readings()[:k]:
                new &= counts(other != reading, size) > 0
            yield window_hashes(reading, size), new & (counts(~self.is_slot(reading), size) >= need), everywhere
        capital = counts(name, size)
        some = np.flatnonzero((capital > 1) & (capital <= CHOICES))
        if not len(some):
            return
        spread = some[:, None] + np.arange(size)
        place = np.cumsum(name[spread], axis=1) - 1
        known = [reading[spread] for reading in codes.readings()]
        for choice in range(1, 2**CHOICES - 1):
            chosen = name[spread] & (choice >> np.maximum(place, 0) & 1 > 0)
            reading = np.where(chosen, self.vocabulary[NAME], codes.unnamed[spread])
            new = (choice < 2 ** capital[some]) & np.all([(reading != k).any(1) for k in known], axis=0)
            hashes = np.array([window_hashes(row, size)[0] for row in reading], "uint64")
            yield hashes, new & ((~self.is_slot(reading)).sum(1) >= need), some

    def possible(self, bodies: list[bytes]) -> list[np.ndarray | None]:
        """Which words of each text have to be coded: those of windows that may match, and the word before each.

        None where no window can: too few words in a row are in the vocabulary or may be slots.
        """
        size = self.shortest
        if not size:
            return [None] * len(bodies)
        begin, end, hashes = word_hashes(body := np.frombuffer(b"\n".join(bodies), "uint8"))
        solid = np.concatenate([[0], np.cumsum(SOLID[body])])
        kept = solid[end] > solid[begin]  # words of ASCII punctuation alone are in no window
        borders = np.searchsorted(begin, np.cumsum([0] + [len(b) + 1 for b in bodies]))
        wanted = ~kept | (hashes == 0)  # whether these are words is for the coder to say
        begin, hashes, places = begin[kept], hashes[kept], np.flatnonzero(kept)
        owner = np.searchsorted(borders, places, "right") - 1
        plain = isin(hashes, self.plain_hashes) | (hashes == 0)  # other words without hash may be punctuation
        known = np.concatenate([[0], np.cumsum(plain)])
        fits = np.concatenate([[0], np.cumsum(plain | OPENS_SLOT[body[begin]] | isin(hashes, self.unit_hashes))])
        near, chosen = np.zeros(len(begin) + 1, "int64"), np.zeros(len(bodies), bool)
        for size in {size for size, _ in self.tables if size <= len(begin)}:
            hit = (fits[size:] - fits[:-size] == size) & (known[size:] - known[:-size] >= min(self.plain, size))
            hit &= owner[: len(hit)] == owner[size - 1 :]
            at = np.flatnonzero(hit)
            chosen[owner[at]] = True
            np.add.at(near, np.maximum(at - 1, 0), 1)
            np.subtract.at(near, at + size, 1)
        wanted[places[np.cumsum(near)[:-1] > 0]] = True
        return [wanted[a:z] if c else None for c, a, z in zip(chosen, borders, borders[1:])]

    def hits(self, coder: Coder, words: list[bytes], wanted: np.ndarray | None = None) -> list[tuple[int, int, int, int, int]]:
        codes = coder.codes(words, wanted)
        diagonals = defaultdict(set)
        for (size, verbatim), (hashes, numbers, places) in self.tables.items():
            if len(codes) < size:
                continue
            readings = [codes.literal] if verbatim else codes.readings()
            for k, reading in enumerate(readings):
                full = counts(reading > 0, size) == size
                for other in readings[:k]:
                    full &= counts(other != reading, size) > 0
                full = np.flatnonzero(full)
                if not len(full):
                    continue
                values = np.zeros(len(full), "uint64")
                for j in range(size):
                    values = (values ^ reading[full + j].astype("uint64")) * FACTOR
                    values ^= values >> np.uint64(29)
                low, high = np.searchsorted(hashes, values, "left"), np.searchsorted(hashes, values, "right")
                for j in np.flatnonzero(high > low):
                    for n, place in zip(numbers[low[j] : high[j]].tolist(), places[low[j] : high[j]].tolist()):
                        diagonals[n].add(int(full[j]) - place)
        if len(diagonals) > 32:
            diagonals = self.hopeful(diagonals, codes)
        out = []
        for number, shifts in sorted(diagonals.items()):
            item_id, _, item = self.items[number]
            found = sorted((place + shift, place) for shift in shifts for place in self.alike(item, codes, shift))
            result = self.agree(number, found, words, codes)
            if result[1] >= min(self.covered, len(item)):
                out.append((item_id, *result))
        return out

    def hopeful(self, diagonals: dict[int, set[int]], codes: Codes) -> dict[int, set[int]]:
        """The items that can be covered enough, all compared at once: many may share a phrase and nothing else.

        Counts words in windows that match on some diagonal, whatever their slots stand for; no hit is lost.
        """
        number, shift = np.array([(n, d) for n, found in diagonals.items() for d in found], "int64").T
        begin, length = self.begins[number], self.begins[number + 1] - self.begins[number]
        first = np.maximum(0, -shift)
        size = np.maximum(np.minimum(length, len(codes) - shift) - first, 0)
        ends = np.cumsum(size)
        pair = np.repeat(np.arange(len(number)), size)
        word = np.arange(len(pair)) - (ends - size)[pair] + first[pair]
        here, there = begin[pair] + word, word + shift[pair]
        named = self.names[here]
        same = (self.literals[here] == codes.literal[there]) | ((named == codes.named[there]) & self.is_slot(named))
        window = np.minimum(length, self.window)[pair]
        sums = np.concatenate([[0], np.cumsum(same)])
        at = np.flatnonzero(np.arange(len(pair)) + window <= ends[pair])
        at = at[sums[at + window[at]] - sums[at] == window[at]]
        inside = np.zeros(len(pair) + 1, "int64")
        np.add.at(inside, at, 1)
        np.subtract.at(inside, at + window[at], 1)
        words = np.zeros(len(self.literals) + 1, "int64")
        words[1 + here[np.cumsum(inside)[:-1] > 0]] = 1  # a word of an item counts once, wherever it matches
        covered = np.diff(np.cumsum(words)[self.begins])
        enough = covered >= np.minimum(self.covered, np.diff(self.begins))
        return {n: found for n, found in diagonals.items() if enough[n]}

    def alike(self, item: Codes, codes: Codes, shift: int) -> list[int]:
        """Positions of the windows of a diagonal that match but for the values of slots, with enough plain words or verbatim."""
        size = min(self.window, len(item))
        first, stop = max(0, -shift), min(len(item), len(codes) - shift)
        if stop - first < size:
            return []
        here, there = slice(first, stop), slice(first + shift, stop + shift)
        equal = item.literal[here] == codes.literal[there]
        slot = self.is_slot(item.named[here]) & (item.named[here] == codes.named[there])
        plain = equal & ~(self.is_slot(item.inside[here]) & self.is_slot(codes.inside[there]))
        fits = (counts(plain, size) >= min(self.plain, size)) | (counts(equal, size) == size)
        return (first + np.flatnonzero(fits & (counts(equal | slot, size) == size))).tolist()

    def agree(self, number: int, found: list[tuple[int, int]], words: list[bytes], codes: Codes) -> tuple[int, int, int, int]:
        """Windows, words, slots and changed slots of the best chain of windows whose slots agree with those before them."""
        _, forms, item = self.items[number]
        size, slot = min(self.window, len(item)), self.is_slot(item.named)
        best, begun = (0, 0, 0, 0), set()
        for start, (at, place) in enumerate(found):
            if at - place not in begun:
                begun.add(at - place)
                alone = [(a, p) for a, p in found[start:] if a - p == at - place]
                best = max(best, *(self.chain(item, forms, slot, size, part, words, codes) for part in (alone, found[start:])), key=lambda r: (r[1], r))
        return best

    def chain(self, item: Codes, forms: list[str], slot: np.ndarray, size: int, found: list, words: list[bytes], codes: Codes) -> tuple[int, int, int, int]:
        """The same of the chain that begins with the first window and takes each next one that follows and agrees."""
        there: dict[str, str] = {}
        back: dict[str, str] = {}
        covered, slots, windows, last = set(), {}, 0, found[0]
        for at, place in found:
            if at > last[0] + len(item) + size:
                break
            ahead, along = at - last[0], place - last[1]
            if ahead != along and not (size <= ahead <= size + self.window and size <= along <= size + self.window):
                continue
            pairs = [(k, forms[k], literal(words[codes.at[k + at - place]])) for k in range(place, place + size) if slot[k]]
            new_there, new_back = dict(there), dict(back)
            if all(new_there.setdefault(a, b) == b and new_back.setdefault(b, a) == a for _, a, b in pairs):
                there, back, last = new_there, new_back, (at, place)
                windows += 1
                covered.update(range(place, place + size))
                slots.update((k, a != b) for k, a, b in pairs)
        return windows, len(covered), len(slots), sum(slots.values())


def isin(values: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    if not len(ordered):
        return np.zeros(len(values), bool)
    return ordered[np.minimum(np.searchsorted(ordered, values), len(ordered) - 1)] == values


def search_texts(index: Index, coder: Coder, part: list[str | None], portion: int = 1_000_000) -> list[list[tuple]]:
    """Hits of each text. Most texts are ruled out by hashes of their words before any is coded."""
    bodies = [t.encode("utf-8", "surrogatepass") if t else b"" for t in part]
    out, at = [], 0
    while at < len(bodies):
        stop, size = at, 0
        while stop < len(bodies) and (stop == at or size + len(bodies[stop]) <= portion):
            size += len(bodies[stop])
            stop += 1
        for body, possible in zip(bodies[at:stop], index.possible(bodies[at:stop])):
            # The two letters whose lower case is a plain ASCII letter escape the hashes.
            odd = b"\xe2\x84\xaa" in body or b"\xc4\xb0" in body
            out.append([] if possible is None and not odd else index.hits(coder, body.split(), None if odd else possible))
        at = stop
    return out


def with_hits(docs: DataFrame, items: list[tuple[int, str | None]], column: str = "hits", **options) -> DataFrame:
    """All columns of `docs` and the list of items that its text contains. Rows stay where they are."""
    sent = docs.sparkSession.sparkContext.broadcast(Index(items, **options))  # at most BLOCK_ITEMS items

    @F.pandas_udf(HITS)
    def search(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        index = sent.value
        coder = Coder(index.vocabulary)
        for part in parts:
            names = ("item_id", "n_windows", "n_words", "n_slots", "n_changed")
            yield pd.Series([[dict(zip(names, h)) for h in hits] for hits in search_texts(index, coder, part.tolist())])

    return docs.withColumn(column, search(F.col("text").cast("string")))


def blocks_of(benchmark: DataFrame, size: int = BLOCK_ITEMS) -> Iterator[list[tuple[int, str | None]]]:
    """The benchmark, block by block in the driver, never whole."""
    block = []
    for row in benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("string")).toLocalIterator():
        block.append((row[0], row[1]))
        if len(block) == size:
            yield block
            block = []
    yield block


def contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """doc_id, item_id, matched windows and words, slots and changed slots of each item within each document."""
    out = None
    for block in blocks_of(benchmark):
        found = with_hits(texts(docs), block, "hits", **options).select("doc_id", F.explode("hits").alias("hit")).select("doc_id", "hit.*")
        out = found if out is None else out.unionByName(found)
    return out


def clean_documents(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of `docs`, all columns, that contain no item."""
    kept = docs
    for block in blocks_of(benchmark):
        kept = with_hits(kept, block, "__hits", **options).where(F.size("__hits") == 0).drop("__hits")
    return kept
