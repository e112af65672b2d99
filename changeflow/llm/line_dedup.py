"""Fuzzy line dedup: pigeonhole blocks of words, SimHash, edit similarity, connected groups."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from changeflow.llm.common import column, components, forest, gathered, majority_bits, pairs_in, \
    ready, slices, texts, whole_groups
from changeflow.session import release, written

MAX_BITS = 17  # that the SimHashes of two long lines may differ in
SHORT_BITS = 24  # and those of two short ones, which are of letters
SIMILAR = 0.8  # edit similarity of two lines at least
LONG = 10  # words from which on a line's SimHash is of words
ONE_LESS = 11  # words up to which a line is sought by all of them but one
GRAMS_FROM = 8  # and from which on by some of its word triples
LETTERS = {2: 4, 5: 6}  # and up to which by some runs of so many letters too
KEYS = 6  # triples or runs a line is sought by
BLOCK = 1024  # lines of a list that one task compares with each other
VERIFIED = 256  # lines of a list whose texts one task compares
LARGE = 64  # lines from which on a list is compared as a table
JOINT = 8  # alike lines of a block from which on one of them goes on to another round
BLOOM = 1 << 25  # bits of the filter in front of the second reading, 4 MB
BASE = 0x9E3779B97F4A7C15  # an odd number whose powers weigh the bytes of a word
# Characters that are no letters or digits part words like blanks: ASCII ones, and others.
PARTS = bytes(c if c > 127 or chr(c).isalnum() or c == 10 else 32 for c in range(256))
OTHER_PARTS = re.compile(r"[^\w\x00-\x7f]+")


def normal_lines(text: str) -> list[bytes]:
    """For each line its words in lower case with one blank between; if it has no words but
    signs, the line as it is. The whole text is folded at once; line feeds stay."""
    lower = text.lower()
    if not lower.isascii():
        lower = OTHER_PARTS.sub(" ", lower)
    forms = [b" ".join(line.split())
             for line in lower.encode("utf-8", "replace").translate(PARTS).split(b"\n")]
    if not all(forms):
        lines = text.split("\n")
        forms = [f or line.strip().encode("utf-8", "replace") for f, line in zip(forms, lines)]
    return forms


def normal(line: str) -> bytes:
    """The normal form of a line."""
    return normal_lines(line)[0]


@lru_cache(maxsize=4)
def powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """The powers of ``BASE`` and of its inverse modulo 2^64."""
    def of(base: int) -> np.ndarray:
        weights = np.full(size, base, "<u8")
        weights[0] = 1
        return np.multiply.accumulate(weights)
    return of(BASE), of(pow(BASE, -1, 1 << 64))


class Words:
    """The words of many normal forms as hashes, with the forms they are of.

    A word's hash is the sum of its bytes times powers of a base, well mixed; all
    words of all forms are summed at once.
    """

    def __init__(self, forms: list[bytes]):
        self.forms = forms
        text = np.frombuffer(b"\n".join(forms), "u1")
        ends = np.cumsum([len(f) + 1 for f in forms])
        parted = text == 32
        parted[ends[:-1] - 1] = True
        starts = np.concatenate([[0], np.flatnonzero(parted) + 1])
        up, down = powers(1 << max(len(text) - 1, 1).bit_length())
        weighed = np.where(parted, 0, text).astype("<u8") * up[:len(text)]
        self.hashes = _mixed(np.add.reduceat(weighed, starts) * down[starts])
        self.sizes = np.diff(np.concatenate([[0], np.searchsorted(starts, ends)]))
        self.form = np.repeat(np.arange(len(forms)), self.sizes)

    def simhashes(self) -> np.ndarray:
        """The SimHash of each form, over its different words, or its letter triples if it has
        fewer than ``LONG`` words.

        A word counts once, or the common words of a language would make its long
        lines look alike. Changed words of a short line would change too many bits.
        """
        order = np.lexsort((self.hashes, self.form))
        mixed, form = self.hashes[order], self.form[order]
        first = np.ones(len(mixed), bool)
        first[1:] = (mixed[1:] != mixed[:-1]) | (form[1:] != form[:-1])
        first &= self.sizes[form] >= LONG
        bits = majority_bits(mixed[first], np.bincount(form[first], minlength=len(self.forms)))
        short = np.flatnonzero(self.sizes < LONG)
        number, runs = _runs([self.forms[n] for n in short.tolist()], 3)
        bits[short] = majority_bits(_mixed(runs * np.uint64(BASE)), np.bincount(
            number, minlength=len(short)))
        return bits

    def keys(self) -> tuple[np.ndarray, np.ndarray]:
        """(form, 32-bit key) of the pigeonhole blocks each form is sought by, sorted.

        A change of a few words leaves other blocks of them as they were. Short lines have
        a key for all their words and for all but each one; longer ones for the ``KEYS``
        word triples of the smallest hashes, and the shortest for runs of letters.
        """
        found = [self._one_less(), self._triples(), self._letters()]
        form, key = (np.concatenate(side) for side in zip(*found))
        both = _once(form.astype("<u8") << np.uint64(32) | key)
        return (both >> np.uint64(32)).astype("i8"), (both & np.uint64(0xFFFFFFFF)).astype("<u4")

    def _one_less(self) -> tuple[np.ndarray, np.ndarray]:
        few = (self.sizes >= 2) & (self.sizes <= ONE_LESS)
        own = few[self.form]
        form, sizes = self.form[own], self.sizes[few]
        if not len(form):
            return form, np.zeros(0, "<u8")
        starts = np.cumsum(sizes) - sizes
        up, down = powers(16)
        weighed = self.hashes[own] * up[np.arange(len(form)) - np.repeat(starts, sizes)]
        whole = np.add.reduceat(weighed, starts)
        upto = np.cumsum(weighed)
        upto -= np.repeat(upto[starts] - weighed[starts], sizes)
        rest = np.repeat(whole, sizes) - upto  # what is behind a word moves up by one place
        less = upto - weighed + rest * down[1]
        return np.concatenate([form, np.flatnonzero(few)]), \
            _mixed(np.concatenate([less, whole])) >> np.uint64(32)

    def _triples(self) -> tuple[np.ndarray, np.ndarray]:
        """The triples with the smallest hashes of each form that is long enough."""
        if len(self.hashes) < 3:
            return np.zeros(0, "i8"), np.zeros(0, "<u8")
        form = self.form[:-2]
        there = (form == self.form[2:]) & (self.sizes[form] >= GRAMS_FROM)
        h, up = self.hashes, powers(16)[0]
        triple = _mixed(h[:-2][there] + h[1:-1][there] * up[1] + h[2:][there] * up[2]) ^ np.uint64(1)
        return _smallest(form[there], triple >> np.uint64(32))

    def _letters(self) -> tuple[np.ndarray, np.ndarray]:
        """The runs of letters with the smallest hashes of the shortest forms."""
        found, least = [], 1
        for most, size in LETTERS.items():
            short = np.flatnonzero((self.sizes >= least) & (self.sizes <= most))
            number, runs = _runs([self.forms[n] for n in short.tolist()], size)
            hashed = _mixed(runs * np.uint64(BASE) + np.uint64(size))
            found.append(_smallest(short[number], hashed >> np.uint64(32)))
            least = most + 1
        return tuple(np.concatenate(side) for side in zip(*found))


def _runs(forms: list[bytes], size: int) -> tuple[np.ndarray, np.ndarray]:
    """(form, run) of all runs of ``size`` bytes, as numbers; a shorter form is one run."""
    if not forms:
        return np.zeros(0, "i8"), np.zeros(0, "<u8")
    filled = [f.ljust(size, b"\0") for f in forms]
    text = np.frombuffer(b"".join(filled), "u1").astype("<u8")
    sizes = np.array([len(f) for f in filled])
    counts = sizes - size + 1
    number = np.repeat(np.arange(len(forms)), counts)
    at = np.arange(len(number)) + (size - 1) * number
    return number, sum(text[at + i] << np.uint64(8 * i) for i in range(size))


def _smallest(form: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ``KEYS`` smallest different keys of each form."""
    both = _once(form.astype("<u8") << np.uint64(32) | key)
    form, key = both >> np.uint64(32), both & np.uint64(0xFFFFFFFF)
    first = np.arange(len(form)) - np.searchsorted(form, form) < KEYS
    return form[first].astype("i8"), key[first]


def _once(values: np.ndarray) -> np.ndarray:
    """The different values in order."""
    values = np.sort(values)
    first = np.ones(len(values), bool)
    first[1:] = values[1:] != values[:-1]
    return values[first]


def _mixed(hashes: np.ndarray) -> np.ndarray:
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        hashes = (hashes ^ (hashes >> np.uint64(shift))) * np.uint64(factor)
    return hashes ^ (hashes >> np.uint64(31))


def simhashes(forms: list[bytes]) -> np.ndarray:
    """The SimHash of each normal form."""
    return Words(forms).simhashes() if forms else np.zeros(0, "<u8")


def within(a: str, b: str, similar: float = SIMILAR) -> bool:
    """Whether 1 - distance / longer length is at least ``similar`` (Levenshtein's distance)."""
    longer = max(len(a), len(b))
    most = int((1 - similar) * longer + 1e-9)
    if abs(len(a) - len(b)) > most:
        return False
    head = _common(a, b)
    a, b = a[head:], b[head:]
    tail = _common(a[::-1], b[::-1])
    a, b = a[:len(a) - tail], b[:len(b) - tail]
    if max(len(a), len(b)) <= most:
        return True
    left, right = a.split(" "), b.split(" ")
    if _at_most(left, right, most) <= most:
        return True
    have, want = Counter(a), Counter(b)
    if max((have - want).total(), (want - have).total()) > most:
        return False
    return _distance(*sorted((a, b), key=len), most) <= most


def _common(a: str, b: str) -> int:
    """The length of the common start, found by pieces."""
    at, step, shorter = 0, 1 << 12, min(len(a), len(b))
    while at < shorter:
        if a[at:at + step] == b[at:at + step]:
            at = min(at + step, shorter)
        elif step > 1:
            step //= 2
        else:
            break
    return at


LOOK = 6  # words that are passed over to find the next common one


def _at_most(left: list[str], right: list[str], enough: int = 1 << 62) -> int:
    """A number of changes of letters that makes one list of words the other.

    Words that do not agree are replaced as a whole, up to the next that do; beyond
    ``enough`` changes all that is left.
    """
    cost = i = j = 0
    while i < len(left) and j < len(right) and cost <= enough:
        if left[i] == right[j]:
            i += 1
            j += 1
            continue
        passed = LOOK, LOOK
        for gap in range(1, LOOK):
            if left[i + gap:i + gap + 1] == right[j + gap:j + gap + 1] != []:
                passed = gap, gap
                break
            near = left[i + gap:i + gap + 1]
            if near and (at := _found(right, near[0], j, j + gap)) >= 0:
                passed = gap, at - j
                break
            near = right[j + gap:j + gap + 1]
            if near and (at := _found(left, near[0], i, i + gap)) >= 0:
                passed = at - i, gap
                break
        cost += max(sum(len(w) + 1 for w in left[i:i + passed[0]]),
                    sum(len(w) + 1 for w in right[j:j + passed[1]]))
        i, j = i + passed[0], j + passed[1]
    return cost + max(sum(len(w) + 1 for w in left[i:]), sum(len(w) + 1 for w in right[j:]))


def _found(words: list[str], word: str, first: int, end: int) -> int:
    return next((n for n in range(first, min(end, len(words))) if words[n] == word), -1)


LOOK_AT = 32  # letters after which a distance is looked at


def _distance(a: str, b: str, most: int) -> int:
    """Levenshtein's distance, a column of the table as the bits of two numbers.

    The bits tell where the distance to the next row rises or falls; with the column's
    number they give the distance in its last row. It stops, with a number above ``most``,
    where the rest of ``b`` can no longer bring it down.
    """
    at: dict[str, int] = {}
    for i, letter in enumerate(a):
        at[letter] = at.get(letter, 0) | 1 << i
    rows = [at.get(letter, 0) for letter in b]
    every = (1 << len(a)) - 1
    rises, falls = every, 0
    for done in range(0, len(b), LOOK_AT):
        for same in rows[done:done + LOOK_AT]:
            steady = ((((same & rises) + rises) ^ rises) | same | falls) & every
            up = (falls | (every ^ (steady | rises))) << 1 | 1
            falls = up & steady
            rises = (((rises & steady) << 1) | (every ^ ((steady | up) & every))) & every
        done = min(done + LOOK_AT, len(b))
        found = done + rises.bit_count() - falls.bit_count()
        if found - (len(b) - done) > most:
            return most + 1
    return found if b else len(a)


ROW = 64  # letters of lines whose distances are taken many at once


def distances(left: np.ndarray, left_sizes: np.ndarray, right: np.ndarray,
              right_sizes: np.ndarray) -> np.ndarray:
    """Levenshtein's distances of rows of code points (at most ``ROW`` of each, zeros behind).

    The same columns of bits as in ``_distance``, one 64-bit number for each pair.
    """
    one = np.uint64(1)
    every = ~np.uint64(0) >> (np.uint64(64) - np.maximum(left_sizes, 1).astype("<u8"))
    top = one << (np.maximum(left_sizes, 1) - 1).astype("<u8")
    rises, falls, found = every.copy(), np.zeros(len(left), "<u8"), left_sizes.astype("i8")
    for at in range(int(right_sizes.max(initial=0))):
        on = right_sizes > at
        equal = (left == right[:, at:at + 1]) & (right[:, at:at + 1] != 0)
        same = np.packbits(equal, axis=1, bitorder="little").view("<u8")[:, 0]
        steady = (((same & rises) + rises) ^ rises) | same | falls
        up = falls | (every & ~(rises | steady))
        down = rises & steady
        found += on * (((up & top) != 0).astype("i8") - ((down & top) != 0))
        up = (up << one) | one
        new_rises = ((down << one) | ~(steady | up)) & every
        rises = np.where(on, new_rises, rises)
        falls = np.where(on, up & steady & every, falls)
    return np.where(left_sizes == 0, right_sizes, found)


def _rows(forms: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The code points of the forms of at most ``ROW`` letters, a row each, and all sizes."""
    sizes = np.array([len(f) for f in forms])
    text = "".join(f.ljust(ROW, "\0") if len(f) <= ROW else "\0" * ROW for f in forms)
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").reshape(-1, ROW), sizes


WIDE = 1 << 11  # letters up to which longer lines are compared many at once too
TOGETHER = 1024  # pairs of lines that are compared at once
PLACES = 1 << 21  # words of 64 bits that tell where the letters of these lines are, 16 MB


def within_many(pairs: list[tuple[str, str]], similar: float = SIMILAR) -> np.ndarray:
    """What ``within`` says of each pair.

    What two lines start and end with alike is left out. Pairs whose shorter lines have about
    the same length are compared together; few pairs of long lines one by one.
    """
    found = np.zeros(len(pairs), bool)
    rest, most, waiting = [("", "")] * len(pairs), np.zeros(len(pairs), "i8"), []
    for n, (a, b) in enumerate(pairs):
        longer = max(len(a), len(b))
        most[n] = limit = int((1 - similar) * longer + 1e-9)
        if longer > WIDE:
            found[n] = within(a, b, similar)
            continue
        if abs(len(a) - len(b)) > limit:
            continue
        head = _common(a, b)
        a, b = a[head:], b[head:]
        tail = _common(a[::-1], b[::-1])
        a, b = a[:len(a) - tail], b[:len(b) - tail]
        if max(len(a), len(b)) <= limit:
            found[n] = True
        elif a and b:  # else all of the other is too many
            rest[n] = (a, b) if len(a) <= len(b) else (b, a)
            waiting.append(n)
    # Lengths by steps of a half, so that no pair has many more bits than it needs.
    waiting.sort(key=lambda n: (_step(len(rest[n][0])), -len(rest[n][1])))
    at = 0
    while at < len(waiting):
        step = _step(len(rest[waiting[at]][0]))
        together = [n for n in waiting[at:at + TOGETHER] if _step(len(rest[n][0])) == step]
        at += len(together)
        if len(together) < 8:
            for n in together:
                found[n] = _distance(*rest[n], most[n]) <= most[n]
        else:
            found[together] = _within_wide([rest[n] for n in together], most[together])
    return found


def _step(letters: int) -> int:
    """The number of 64-bit words for so many letters, rounded up to one of few numbers."""
    words = 1
    while 64 * words < letters:
        words += max(words // 2, 1)
    return words


def _within_wide(pairs: list[tuple[str, str]], most: np.ndarray) -> np.ndarray:
    """Whether Levenshtein's distance of each (a, b) is ``most`` at most; the longest b first.

    The columns of bits of ``_distance``, in a few 64-bit numbers for each pair. Of a column
    only numbers are looked at that ``most`` changes can reach: each letter that is left out
    of a line moves the rest by one place, and must be made up for by the line's end. Numbers
    above those count as they would at most, which is what they began with, and the first
    one's distance rises by one a column at most. Pairs that are through, or can no longer
    come down to ``most``, are left out of the columns that follow.
    """
    left, right = ([pair[side] for pair in pairs] for side in (0, 1))
    left_sizes, right_sizes = (np.array([len(x) for x in side]) for side in (left, right))
    letters = [np.frombuffer("".join(side).encode("utf-32-le", "surrogatepass"), "<u4")
               for side in (left, right)]
    both = np.concatenate(letters)
    number = np.cumsum(np.bincount(both) > 0) - 1  # of each letter that there is
    codes, known = number[both], int(number[-1]) + 1
    total, words = len(pairs), -(-int(left_sizes.max()) // 64)
    if known * words * total > PLACES and total > 1:
        half = total // 2
        return np.concatenate([_within_wide(pairs[:half], most[:half]),
                               _within_wide(pairs[half:], most[half:])])
    pair, place = _numbered(left_sizes)
    where = np.zeros(words * known * total, "<u8")
    np.add.at(where, (place // 64 * known + codes[:len(pair)]) * total + pair,
              np.uint64(1) << (place % 64).astype("<u8"))
    where = where.reshape(words, -1)
    pair, place = _numbered(right_sizes)
    columns = np.zeros((int(right_sizes[0]), total), "i8")
    columns[place, pair] = codes[letters[0].size:] * total + pair
    # The bits of each pair's own letters.
    own = np.clip(left_sizes - 64 * np.arange(words)[:, None], 0, 64)
    own = np.where(own > 0, ~np.uint64(0) >> np.minimum(64 - own, 63).astype("<u8"), np.uint64(0))
    one, last, every = np.uint64(1), np.uint64(63), ~np.uint64(0)
    rises, falls = np.full((words, total), every), np.zeros((words, total), "<u8")
    out, live, passed = np.zeros(total, bool), np.arange(total), np.zeros(total, "i8")
    more, fewer = (most + right_sizes - left_sizes) // 2, (most - right_sizes + left_sizes) // 2
    done = first = 0
    while len(live):
        until = min(done + LOOK_AT, int(right_sizes[live].min()))
        before, first = first, min(max(done + 1 - int(more[live].max()), 0) // 64, words - 1)
        passed += _steps(rises[before:first], falls[before:first])
        end = max(min(-(-(until + int(fewer[live].max())) // 64), words), first + 1)
        here, rise, fall = where[first:end], rises[first:end], falls[first:end]
        for column in columns[done:until, live]:
            same = here.take(column, axis=1)
            steady = same & rise
            steady += rise
            carry = steady < rise
            if end - first > 1:
                full, over = steady[1:] == every, carry[:-1]
                while True:  # a full number hands on what comes from the one below
                    handed = full & over & ~carry[1:]
                    if not handed.any():
                        break
                    carry[1:] |= handed
                steady[1:] += over
            steady ^= rise
            steady |= same
            steady |= fall
            up = ~(rise | steady)
            up |= fall
            down = rise & steady
            high_up, high_down = up[:-1] >> last, down[:-1] >> last
            up <<= one
            down <<= one
            up[1:] |= high_up
            down[1:] |= high_down
            up[0] |= one
            np.bitwise_and(up, steady, out=fall)
            steady |= up
            np.bitwise_or(down, ~steady, out=rise)
        done = until
        found = done + passed + _steps(rises[first:] & own[first:], falls[first:] & own[first:])
        out[live] = found - (right_sizes[live] - done) <= most[live]
        on = out[live] & (right_sizes[live] > done)
        if not on.all():
            live, passed = live[on], passed[on]
            rises, falls, own = rises[:, on], falls[:, on], own[:, on]
    return out


def _numbered(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(group, place in it) of each member of groups of these sizes."""
    group = np.repeat(np.arange(len(sizes)), sizes)
    return group, np.arange(len(group)) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def _steps(rises: np.ndarray, falls: np.ndarray) -> np.ndarray:
    """By how much the distances rise over these bits, for each pair."""
    return np.bitwise_count(rises).sum(axis=0, dtype="i8") \
        - np.bitwise_count(falls).sum(axis=0, dtype="i8")


LETTER_BINS = 64  # in which the letters of a line are counted


def _letter_counts(forms: list[str], sizes: np.ndarray) -> np.ndarray:
    """How many letters of each bin a form has, a row each; counts stop at the largest 16-bit one."""
    text = np.frombuffer("".join(forms).encode("utf-32-le", "surrogatepass"), "<u4")
    row = np.repeat(np.arange(len(forms)), sizes)
    places = row * LETTER_BINS + text % LETTER_BINS
    counts = np.bincount(places, minlength=len(forms) * LETTER_BINS)
    return np.minimum(counts, (1 << 15) - 1).astype("i2").reshape(-1, LETTER_BINS)


def _may_be_alike(counts: np.ndarray, i: np.ndarray, j: np.ndarray, most: np.ndarray) -> np.ndarray:
    """Whether so many changes can make the letters of one form those of the other.

    A change takes one letter away at most and adds one at most, so this never rules
    out two forms within that distance.
    """
    out = np.empty(len(i), bool)
    for at in range(0, len(i), 1 << 13):
        piece = slice(at, at + (1 << 13))
        differ = counts[i[piece]] - counts[j[piece]]
        more = np.maximum(differ, 0).sum(axis=1, dtype="i8")
        less = more - differ.sum(axis=1, dtype="i8")
        out[piece] = np.maximum(more, less) <= most[piece]
    return out


def _who(ident: str, text: str) -> list[Column]:
    """A document: its ident and its text's hash; rows equal in both are the same one."""
    return [F.col(ident).alias("ident"), F.xxhash64(F.col(text), F.col(text).isNull()).alias("text_hash")]


def _lines(docs: DataFrame) -> DataFrame:
    """Each line with words or signs: its document, number, hashes, SimHash and keys.

    ``h1`` and ``h2`` are of the normal form, ``raw`` of the line as it stands;
    ``size`` is the form's number of letters, negative if it has ``LONG`` words.
    """
    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch):
                yield _cut(piece)

    added = {"line": "int", "h1": "bigint", "h2": "bigint", "bits": "bigint", "raw": "bigint",
             "size": "int"}
    schema = docs.drop("text").withColumns({
        **{name: F.lit(0).cast(kind) for name, kind in added.items()},
        "keys": F.array(F.lit(0))}).schema
    return docs.mapInArrow(cut, schema)


def _cut(batch: pa.RecordBatch) -> pa.RecordBatch:
    rows, numbers, forms, raw = [], [], [], []
    for row, text in enumerate(texts(batch, "text")):
        text = text or ""
        for number, (line, form) in enumerate(zip(text.split("\n"), normal_lines(text))):
            if form:
                rows.append(row)
                numbers.append(number)
                forms.append(form)
                raw.append(_raw(line))
    both = _marks(forms)
    out = batch.drop_columns(["text"]).take(pa.array(rows, pa.int64()))
    words = Words(forms) if forms else None
    form, key = words.keys() if words else (np.zeros(0, "i8"), np.zeros(0, "<u4"))
    ends = np.searchsorted(form, np.arange(len(forms) + 1)).astype("i4")
    for name, values in (
            ("line", pa.array(numbers, pa.int32())), ("h1", pa.array(both[:, 0])),
            ("h2", pa.array(both[:, 1])),
            ("bits", pa.array((words.simhashes() if words else np.zeros(0, "<u8")).view("<i8"))),
            ("raw", pa.array(np.array(raw, "<u8").view("<i8"))),
            ("size", pa.array(_sizes(words) if words else np.zeros(0, "i4"))),
            ("keys", pa.ListArray.from_arrays(pa.array(ends), pa.array(key.view("<i4"))))):
        out = out.append_column(name, values)
    return out


def _sizes(words: Words) -> np.ndarray:
    """The number of letters of each form, negative for those of ``LONG`` words or more."""
    text = np.frombuffer(b"\n".join(words.forms), "u1")
    starts = np.cumsum([0] + [len(f) + 1 for f in words.forms[:-1]])
    # Bytes that go on with a letter are none of their own; nor is the line feed between forms.
    letters = np.add.reduceat((text & 0xC0 != 0x80).astype("i4"), starts)
    letters[:-1] -= 1
    return np.where(words.sizes >= LONG, -letters, letters).astype("i4")


def _raw(line: str) -> int:
    return xxhash.xxh64_intdigest(line.encode("utf-8", "replace"), 42)


def _marks(forms: list[bytes]) -> np.ndarray:
    """The two halves of each form's 128-bit hash."""
    return np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, forms)), "<i8").reshape(-1, 2)


def _close(distinct: DataFrame, max_bits: int, similar: float) -> DataFrame:
    """(key, cid) of the lines that have a close partner in the list of a key."""
    listed = distinct.select("cid", "bits", "size", F.explode("keys").alias("key"))
    members = F.count(F.lit(1)).over(Window.partitionBy("key"))
    listed = listed.withColumn("members", members).where("members > 1")
    keys = ["key", "lo", "hi"]

    def compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, starts in whole_groups(batches, keys):
            met = np.zeros(table.num_rows, bool)
            for i, j in _near(starts, *_sides(table), max_bits, similar):
                met[i] = met[j] = True
            yield pa.RecordBatch.from_arrays([pa.array(column(table, "key")[met]),
                                              pa.array(column(table, "cid")[met])], ["key", "cid"])

    return gathered(_dealt(listed, BLOCK), keys).select("cid", "bits", "size", "mine", *keys) \
        .mapInArrow(compare, "key int, cid bigint").distinct()


def _dealt(listed: DataFrame, block: int) -> DataFrame:
    """Rows of lists of so many ``members``, dealt to pairs of blocks as ``spread`` does."""
    blocks = F.ceil(F.col("members") / block)
    mine = F.pmod(F.xxhash64("cid"), blocks).cast("int")
    other = F.explode(F.sequence(F.lit(0), (blocks - 1).cast("int")))
    return listed.withColumn("mine", mine).withColumn("other", other).withColumns({
        "lo": F.least("mine", "other"), "hi": F.greatest("mine", "other")}).drop("other", "members")


def _listed(close: DataFrame) -> DataFrame:
    """The lists of each line, in order: those of one block of ``VERIFIED`` lines, and larger ones."""
    members = F.count(F.lit(1)).over(Window.partitionBy("key"))
    small = F.col("members") <= VERIFIED
    return close.withColumn("members", members).where("members > 1").groupBy("cid").agg(
        F.sort_array(F.collect_list(F.when(small, F.col("key")))).alias("lists"),
        F.sort_array(F.collect_list(F.when(~small, F.struct("key", "members")))).alias("larges"))


def _sides(table: pa.Table) -> tuple[np.ndarray, ...]:
    """SimHashes, own blocks, whether two blocks meet, and lines' sizes."""
    return (column(table, "bits").view("<u8"), column(table, "mine"),
            column(table, "lo") != column(table, "hi"), column(table, "size"))


def _near(starts: np.ndarray, bits: np.ndarray, mine: np.ndarray, crossing: np.ndarray,
          size: np.ndarray, max_bits: int, similar: float,
          root: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows of the same group that are close: their sizes let them be alike, and if both are
    long their bits differ in ``max_bits`` places at most, if both are short in ``SHORT_BITS``.
    Rows of the same ``root``, if given, are passed over.

    Small groups are paired together; a large one is a table of its rows, or of the
    rows of its two blocks.
    """
    ends = np.append(starts[1:], len(bits))
    small = ends - starts < LARGE
    own = np.repeat(small, ends - starts)
    rows = np.flatnonzero(own)
    sizes = (ends - starts)[small]
    letters, long = np.abs(size), size < 0

    def fitting(i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        fits = np.abs(letters[i] - letters[j]) <= _most(letters[i], letters[j], similar)
        return i[fits], j[fits]

    for i, j in pairs_in(np.cumsum(sizes) - sizes, len(rows)):
        i, j = rows[i], rows[j]
        near = _few(np.bitwise_count(bits[i] ^ bits[j]), long[i], long[j], max_bits)
        near &= ~crossing[i] | (mine[i] != mine[j])
        if root is not None:
            near &= root[i] != root[j]
        yield fitting(i[near], j[near])
    for start, end in zip(starts[~small], ends[~small]):
        group = np.arange(start, end)
        left = right = group
        if crossing[start]:
            left, right = group[mine[group] == mine[start]], group[mine[group] != mine[start]]
        for at in range(0, len(left), 256):
            piece = left[at:at + 256]
            differ = np.bitwise_count(bits[piece][:, None] ^ bits[right])
            near = _few(differ, long[piece][:, None], long[right], max_bits)
            if root is not None:
                near &= root[piece][:, None] != root[right]
            i, j = np.nonzero(near)
            i, j = piece[i], right[j]
            once = (i < j) | crossing[start]
            yield fitting(i[once], j[once])


def _few(differ: np.ndarray, one: np.ndarray, other: np.ndarray, max_bits: int) -> np.ndarray:
    return (one != other) | (differ <= np.where(one, max_bits, SHORT_BITS))


def _most(one: np.ndarray, other: np.ndarray, similar: float) -> np.ndarray:
    """How many letters may be changed between lines of these sizes that are alike."""
    return ((1 - similar) * np.maximum(one, other) + 1e-9).astype("i8")


def _by_size(listed: DataFrame, block: int, similar: float) -> DataFrame:
    """Rows of lists, cut to blocks in order of their letters and dealt to pairs of blocks.

    Only blocks meet that hold lines of sizes which may be alike, so of a long list a row
    goes to few of them.
    """
    place = F.row_number().over(Window.partitionBy("key").orderBy(F.abs("size"), "cid"))
    placed = listed.withColumn("mine", F.floor((place - 1) / block).cast("int"))
    ends = placed.groupBy("key", "mine").agg(F.min(F.abs("size")).alias("least"),
                                             F.max(F.abs("size")).alias("most"))
    # The fewest letters that a line of this block or a later one can be like.
    fewest = F.col("least") - F.floor((1 - similar) * F.col("least") + 1e-9)
    later = ends.select("key", F.col("mine").alias("hi"), fewest.alias("fewest"))
    met = ends.withColumnRenamed("mine", "lo").join(later, "key") \
        .where("lo <= hi AND fewest <= most").select("key", "lo", "hi")
    sides = F.explode(F.array_distinct(F.array("lo", "hi"))).alias("mine")
    return placed.join(met.select("key", "lo", "hi", sides), ["key", "mine"])


def _alike(close: DataFrame, formed: DataFrame, max_bits: int, similar: float,
           held: list[str] | None = None) -> DataFrame:
    """Links (a, b) of lines that are close and alike, directly or by way of others: b is the
    same line for all that are joined.

    A list of more than ``VERIFIED`` lines is cut to blocks. Lines that are alike inside a
    block are linked, and where they are many one of them goes on to the next round, where
    blocks are cut anew from what is left; so a large group of like lines is joined without
    its texts meeting pair by pair. What a round leaves says nothing of the lines that went,
    which may be like others too. So after the rounds all lines of these lists are compared
    block by block, but for those that links join already and blocks of unlike sizes. Tables
    that are written for it are added to ``held``.
    """
    letters = F.length("form")
    met = written(formed.select("cid", "bits", F.when(F.col("long"), -letters).otherwise(letters)
                                .alias("size")).join(_listed(close), "cid"), "met", held)
    formed = formed.select("cid", "form")
    large = met.select("cid", F.explode("larges").alias("list")).select("cid", "list.*")
    met = met.withColumn("larges", F.col("larges.key"))
    rows, links = close, []
    while True:
        members = F.count(F.lit(1)).over(Window.partitionBy("key"))
        blocks = F.ceil(F.col("members") / VERIFIED).cast("int")
        mine = F.pmod(F.xxhash64("cid", F.lit(len(links))), F.col("blocks")).cast("int")
        dealt = rows.withColumn("members", members).where("members > 1") \
            .withColumn("blocks", blocks).withColumn("mine", mine).drop("members") \
            .withColumns({"lo": F.col("mine"), "hi": F.col("mine"), "root": F.col("cid")})
        found = written(_verified(dealt.join(met, "cid"), formed, max_bits, similar), "alike", held)
        links.append(found.where("b IS NOT NULL").select("a", "b"))
        rows = found.where("b IS NULL").select("key", F.col("a").alias("cid"))
        if rows.isEmpty():
            break
    joined = components(reduce(DataFrame.unionByName, links), held)
    if large.isEmpty():
        return joined.toDF("a", "b")
    joined = written(joined, "joined", held)
    keys = Window.partitionBy("key")
    rest = large.join(joined.withColumnRenamed("node", "cid"), "cid", "left") \
        .withColumn("root", F.coalesce("root", "cid")) \
        .withColumn("apart", F.min("root").over(keys) < F.max("root").over(keys)) \
        .where("apart").drop("apart", "members").join(met, "cid")
    rest = _by_size(written(rest, "rest", held), VERIFIED, similar).withColumn("blocks", F.lit(1))
    more = components(written(_verified(rest, formed, max_bits, similar, True), "alike", held)
                      .select("a", "b"), held)
    # The second links are of roots: a root that they move takes its lines along.
    moved = more.select(F.col("node").alias("root"), F.col("root").alias("top"))
    return joined.union(moved.select("root", "root")).distinct().join(moved, "root", "left") \
        .select(F.col("node").alias("a"), F.coalesce("top", "root").alias("b")).distinct()


def _shared(lists: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The first list that two rows have in common, ``NOWHERE`` if there is none."""
    out = np.full(len(i), NOWHERE)
    for at in range(0, len(i), 1 << 14):
        left, right = lists[i[at:at + (1 << 14)]], lists[j[at:at + (1 << 14)]]
        first = out[at:at + (1 << 14)]
        for place in range(lists.shape[1] - 1, -1, -1):
            there = (left[:, place:place + 1] == right).any(axis=1)
            first[there] = left[there, place]
    return out


NOWHERE = 1 << 40  # beyond all keys


def _padded(table: pa.Table, name: str) -> np.ndarray:
    """A column of lists as a table; the places left over agree with no other row's."""
    lists = table.column(name).combine_chunks()
    sizes = lists.value_lengths().to_numpy()
    out = np.full((len(sizes), int(sizes.max(initial=0))), NOWHERE) + np.arange(len(sizes))[:, None]
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = \
        lists.flatten().to_numpy()
    return out


def _own(table: pa.Table, starts: np.ndarray, max_bits: int, similar: float,
         last: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Close rows, each pair in one list only: the first of one block that both are in.

    Rows that are in no such list together are compared in each block of a larger one that
    they meet in, and in the ``last`` round in the first of the larger ones.
    """
    key, lists, larges = column(table, "key"), _padded(table, "lists"), _padded(table, "larges")
    for i, j in _near(starts, *_sides(table), max_bits, similar, column(table, "root")):
        first = _shared(lists, i, j)
        if last:
            own = first == NOWHERE
            i, j = i[own], j[own]
            own = _shared(larges, i, j) == key[i]
        else:
            own = (first == NOWHERE) | (first == key[i])
        yield i[own], j[own]


class _Lines:
    """Normal forms that are compared with each other."""

    def __init__(self, forms: list[str], similar: float):
        self.forms, self.similar = forms, similar
        self.rows, self.sizes = _rows(forms)

    def alike(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Whether the lines of each pair are alike: by counts of letters first, then by distances."""
        most = _most(self.sizes[i], self.sizes[j], self.similar)
        longer, out = np.maximum(self.sizes[i], self.sizes[j]), np.zeros(len(i), bool)
        look = np.flatnonzero(longer <= WIDE)
        if len(look):
            at, place = np.unique(np.concatenate([i[look], j[look]]), return_inverse=True)
            counts = _letter_counts([self.forms[n] for n in at.tolist()], self.sizes[at])
            look = look[_may_be_alike(counts, place[:len(look)], place[len(look):], most[look])]
        short = look[longer[look] <= ROW]
        for at in range(0, len(short), 1 << 14):
            piece = short[at:at + (1 << 14)]
            a, b = i[piece], j[piece]
            out[piece] = distances(self.rows[a], self.sizes[a], self.rows[b], self.sizes[b]) <= most[piece]
        look = np.concatenate([look[longer[look] > ROW], np.flatnonzero(longer > WIDE)])
        out[look] = within_many([(self.forms[x], self.forms[y]) for x, y in
                                 zip(i[look].tolist(), j[look].tolist())], self.similar)
        return out


ROUNDS = 4  # of one pair for each node, before all that are left are compared


def _joined(node: np.ndarray, i: np.ndarray, j: np.ndarray, alike) -> np.ndarray:
    """The smallest node that each node is joined with by the pairs of rows that are ``alike``.

    Pairs whose nodes are joined already are not compared. So the first rounds compare
    one pair for each node, which joins most of a large group.
    """
    roots = np.arange(int(node.max(initial=-1)) + 1)
    for turn in range(ROUNDS + 1):
        x, y = roots[node[i]], roots[node[j]]
        apart = x != y
        i, j, x, y = i[apart], j[apart], x[apart], y[apart]
        if not len(i):
            break
        now = np.arange(len(i))
        if turn < ROUNDS:
            now = np.unique(np.maximum(x, y), return_index=True)[1]
        found = now[alike(i[now], j[now])]
        moved, to = forest(x[found], y[found])
        low = np.arange(len(roots))
        low[moved] = to
        roots = low[roots]
        rest = np.ones(len(i), bool)
        rest[now] = False
        i, j = i[rest], j[rest]
    return roots


def _verified(members: DataFrame, formed: DataFrame, max_bits: int, similar: float,
              last: bool = False) -> DataFrame:
    """Rows (key, a, b): lines that are linked; and (key, a, null): lines of a list of several
    blocks that go on for the many that are linked to them. In the ``last`` round a and b are
    roots.

    Lines that other links already join, within a task or by their ``root``, are not
    compared again, and two lines that meet in several lists only in one of them. So texts go
    only to lists where their line has a partner of its own.
    """
    keys = ["key", "lo", "hi"]
    marked = ["bits", "size", "mine", "blocks", "root", "lists", "larges", *keys]

    def partners(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, starts in whole_groups(batches, keys):
            met = np.zeros(table.num_rows, bool)
            for i, j in _own(table, starts, max_bits, similar, last):
                met[i] = met[j] = True
            yield from table.filter(pa.array(met)).to_batches()

    def verify(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, starts in whole_groups(batches, keys, 1 << 11):
            ends, node = np.unique(column(table, "root" if last else "cid"), return_inverse=True)
            lines = _Lines(table.column("form").to_pylist(), similar)
            pairs = [np.zeros((2, 0), "i8"), *_own(table, starts, max_bits, similar, last)]
            roots = _joined(node, *np.concatenate(pairs, axis=1), lines.alike)
            moved = roots != np.arange(len(roots))
            joint = np.bincount(roots, minlength=len(ends)) >= JOINT
            on = (column(table, "blocks") > 1) & ~moved[node] & joint[node]
            yield pa.RecordBatch.from_arrays([
                pa.array(np.concatenate([np.zeros(moved.sum(), "i4"), column(table, "key")[on]])),
                pa.array(np.concatenate([ends[moved], ends[node[on]]])),
                pa.array(np.concatenate([ends[roots[moved]], ends[node[on]]]),
                         mask=np.arange(moved.sum() + on.sum()) >= moved.sum())], ["key", "a", "b"])

    light = members.select("cid", *marked)
    wanted = gathered(light, keys).mapInArrow(partners, light.schema)
    return gathered(wanted.join(formed, "cid").select("cid", "form", *marked), keys) \
        .mapInArrow(verify, "key int, a bigint, b bigint")


def _filter(raw: DataFrame, held: list[str]) -> np.ndarray:
    """A Bloom filter of hashes (column raw), as 64-bit words; its size is fixed."""
    places = F.explode(F.array(F.col("raw").bitwiseAND(BLOOM - 1),
                               F.shiftrightunsigned("raw", 32).bitwiseAND(BLOOM - 1)))
    words = written(raw.select(places.alias("place"))
                    .groupBy(F.expr("place DIV 64").alias("word"))
                    .agg(F.bit_or(F.expr("shiftleft(1L, CAST(place % 64 AS int))")).alias("bits")),
                    "filter", held).toArrow()
    found = np.zeros(BLOOM // 64, "<i8")
    found[column(words, "word")] = column(words, "bits")
    return found.view("<u8")


def _forms(spark: SparkSession, docs: DataFrame, raw: DataFrame, held: list[str]) -> DataFrame:
    """The normal forms, with their hashes, of at least the lines whose hash is in ``raw``."""
    known = spark.sparkContext.broadcast(_filter(raw, held))

    def form(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lines = [line for text in texts(batch, "text") if text for line in text.split("\n")]
            hashes = np.array([_raw(line) for line in lines], "<u8")
            there = np.ones(len(hashes), bool)
            for place in (hashes & np.uint64(BLOOM - 1), (hashes >> np.uint64(32))
                          & np.uint64(BLOOM - 1)):
                bit = known.value[(place >> np.uint64(6)).astype("i8")] >> (place & np.uint64(63))
                there &= (bit & np.uint64(1)) == 1
            # No line has a line feed, so all of them are folded as one text.
            wanted = [lines[n] for n in np.flatnonzero(there).tolist()]
            forms = list(dict.fromkeys(normal_lines("\n".join(wanted)))) if wanted else []
            both = _marks(forms)
            yield pa.RecordBatch.from_arrays(
                [pa.array(both[:, 0]), pa.array(both[:, 1]),
                 pa.array([f.decode() for f in forms], pa.string())], ["h1", "h2", "form"])

    # A form is the same wherever its hashes are: by all columns no sort is needed.
    return docs.select("text").mapInArrow(form, "h1 bigint, h2 bigint, form string").distinct()


def repeated_lines(spark: SparkSession, docs: DataFrame, ident: str = "doc_id",
                   text: str = "text", max_bits: int = MAX_BITS,
                   similar: float = SIMILAR) -> DataFrame:
    """(ident, text_hash, lines): the numbers of the lines that each document loses.

    See ``without_repeats`` for which lines these are. Texts of lines move only
    where their SimHashes are close to others': such lines are read a second time,
    those that a fixed-size filter rules out are passed over. Only the result stays in the
    shared folder.
    """
    ready(spark)
    held, kept_on = [], []
    small = docs.select(*_who(ident, text), F.col(text).alias("text"))
    lines = written(_lines(small), "lines", kept_on)
    place = F.struct(F.col("ident").isNull().alias("unnamed"), "ident", "text_hash", "line")
    distinct = written(
        lines.groupBy("h1", "h2").agg(
            F.min(F.struct(*[place[c].alias(c) for c in ("unnamed", "ident", "text_hash", "line")],
                           "raw", "bits", "size", "keys")).alias("first"),
            F.count(F.lit(1)).alias("n"))
        .select("h1", "h2", "n", F.col("first").dropFields("raw", "bits", "size", "keys")
                .alias("first"), "first.raw", "first.bits", "first.size", "first.keys")
        .withColumn("cid", F.monotonically_increasing_id()), "distinct", kept_on)
    close = written(_close(distinct, max_bits, similar), "close", held)
    met = written(distinct.join(close.select("cid").distinct(), "cid", "left_semi")
                  .select("cid", "h1", "h2", "raw", "bits", (F.col("size") < 0).alias("long")),
                  "met", held)
    formed = written(_forms(spark, small, met.select("raw"), held)
                     .join(met.drop("raw"), ["h1", "h2"]).drop("h1", "h2"), "forms", held)
    alike = written(_alike(close, formed, max_bits, similar, held), "groups", kept_on) \
        .select(F.col("a").alias("node"), F.col("b").alias("root"))
    release(spark, held)
    groups = distinct.select("h1", "h2", "cid", "first", "n") \
        .join(alike, F.col("cid") == F.col("node"), "left") \
        .withColumn("root", F.coalesce("root", "cid"))
    kept = groups.groupBy("root").agg(F.min("first").alias("kept"), F.sum("n").alias("n")) \
        .where("n > 1").drop("n")
    again = groups.select("h1", "h2", "root").join(kept, "root").select("h1", "h2", "kept")
    gone = written(lines.select("ident", "text_hash", "line", "h1", "h2").join(again, ["h1", "h2"])
                   .where(~place.eqNullSafe(F.col("kept")))
                   .groupBy("ident", "text_hash").agg(F.collect_set("line").alias("lines")), "gone")
    release(spark, kept_on)
    return gone


def without_repeats(spark: SparkSession, docs: DataFrame, ident: str = "doc_id",
                    text: str = "text", length: str | None = None, max_bits: int = MAX_BITS,
                    similar: float = SIMILAR, dropped: str | None = None) -> DataFrame:
    """``docs`` with one occurrence of each group of like lines in all texts.

    Lines are what line feeds part. Their normal forms (words in lower case, parted
    by whatever character is no letter or digit; signs if there are no words) are linked
    where their edit similarity is ``similar`` or more. They are sought by pigeonhole
    blocks of their words (see ``Words.keys``), and of those that share one only lines are
    compared whose 64-bit SimHashes differ in at most ``max_bits`` bits (shorter lines, of
    letters, in ``SHORT_BITS``), which is far beyond what like lines differ in. The README gives
    the share of like lines that are found. Of a
    connected group the first occurrence by ident, hash of the text and line
    stays, null idents last; the other occurrences are taken out of their texts.
    Lines of white space only stay. A document whose every line goes keeps its row
    with an empty text; a null text stays null.

    Rows that agree in ident and text are one document and all get its new text.
    All columns are kept; ``length``, if given, is set to the new text's
    code points where lines went, and ``dropped``, if given, is a new column with
    the number of lines that went. An empty table gives no rows.
    """
    gone = repeated_lines(spark, docs, ident, text, max_bits, similar)
    packed = docs.select(F.struct("*").alias("row"), F.struct(*_who(ident, text)).alias("who"))
    # The lines that go are the smaller side: whole documents need not be sorted.
    lost = gone.select(F.struct("ident", "text_hash").alias("who"), "lines").hint("shuffle_hash")
    joined = packed.join(lost, "who", "left")
    # A text is parted once, in a step of its own, not anew for each of its lines.
    cut = joined.withColumn("cut", F.when(F.col("lines").isNotNull(), F.split(F.col("row")[text], "\n", -1)))
    left = F.array_except(F.sequence(F.lit(0), F.size("cut") - 1), F.col("lines"))
    new = F.array_join(F.transform(left, lambda i: F.get(F.col("cut"), i)), "\n")
    changed = F.when(F.col("lines").isNull(), F.col("row")[text]).otherwise(new)
    fields = {c: F.col("row")[c] for c in docs.columns}
    if length:
        counted = F.when(F.col("lines").isNull(), fields[length]).otherwise(F.length("new"))
        fields[length] = counted.cast(docs.schema[length].dataType)
    fields[text] = F.col("new")
    if dropped:
        fields[dropped] = F.coalesce(F.array_size("lines"), F.lit(0))
    return cut.withColumn("new", changed).select(*[f.alias(c) for c, f in fields.items()])
