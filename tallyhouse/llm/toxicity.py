"""Operator 10: toxicity of texts whose words may be disguised.

A writer's word passes a noisy channel: letters become look-alike signs, are repeated, or are set apart by spaces and dots.
A character trigram model, counted over all documents, says which words are likely.  Places that may be disguised (a sign
before or behind letters, a letter of a-z twice or any three times in a row, single letters and signs set apart, short groups
of letters with one gap sign between two) become a lattice of readings, Viterbi finds the likeliest one, and it replaces the
place where it beats the text as it stands.  A text is scored by both its restored and its shown words, so that restoring only
adds.

The restored text is scored by a lexicon of words and word beginnings.  It is learned from labelled rows outside the held-out
fold, at most ``PER_CLASS`` of either label: entries are taken one by one, each time the one that explains most toxic documents
not explained yet, so words that merely share a document with a toxic one are not learned.  A document's score is the
probability that at least one of its entries is meant.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.llm import bytetext
from tallyhouse.llm.folds import in_fold
from tallyhouse.sources.workdir import settle

FOLDS, HELD_OUT = 4, 2
THRESHOLD = 0.3
#: Bound of the labelled sample that the lexicon is learned from, for each label.
PER_CLASS = 6000
#: An entry explains at least so many toxic documents of the sample, and this share of them, and is right this often.
LEAST_DOCUMENTS, LEAST_SHARE, LEAST_PRECISION = 3, 0.002, 0.8

# Signs that stand for letters.
LOOK_ALIKES = {
    "0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "il", "+": "t",
}
#: Log probabilities of the channel: a sign meant as a letter, a sign meant as itself, a letter repeated, letters set apart.
AS_LETTER, AS_SIGN, REPEATED, APART = np.log([0.3, 0.003, 0.2, 0.3])
#: What the restored reading must gain over the text as it stands, in log probability.
GAIN = 1.0
#: Symbols of the character model: 0 for anything between words, 1-26 for a-z, 27 for any other letter.
SYMBOLS = 28
PREFIXES = (4, 5, 6, 7)
WHOLE = 15

_SIGNS = "".join(LOOK_ALIKES)
_SYMBOL_OF_BYTE = np.zeros(256, np.int64)
_SYMBOL_OF_BYTE[97:123] = _SYMBOL_OF_BYTE[65:91] = np.arange(1, 27)
_SYMBOL_OF_BYTE[192:] = 27
_LETTER_BYTE = _SYMBOL_OF_BYTE > 0
_LETTER_BYTE[128:192] = True
_SIGN_BYTE = np.isin(np.arange(256), list(_SIGNS.encode()))
_S = re.escape(_SIGNS)
_GAP = r"[ .\-_*]"
_UNIT = rf"(?:[^\W\d_]|[{_S}])"
#: Letters and signs set apart by up to three gap signs each, two letters at least.
SET_APART = rf"(?={_UNIT}{_GAP})(?=(?:[{_S}]{_GAP}{{1,3}}){{0,8}}[^\W\d_]{_GAP}{{1,3}}(?:[{_S}]{_GAP}{{1,3}}){{0,8}}[^\W\d_])(?:{_UNIT}{_GAP}{{1,3}}){{2,}}{_UNIT}(?![^\W_]|[{_S}])"
APART_PLACE = re.compile(rf"(?:{_UNIT}{_GAP}+)+{_UNIT}")
#: A word with a sign next to a letter or a letter three times in a row; not the parts of an address.
DISGUISED = (
    rf"(?=[^\W\d_]*(?:[{_S}]+[^\W\d_]|(?<=[^\W\d_])[{_S}]|([^\W\d_])\1\1))"
    rf"(?:[{_S}]|[^\W\d_])++(?![\w@.-]*@)"
)
SUSPECT = re.compile(
    rf"(?<![^\W_])(?<![{_S}]){SET_APART}"
    rf"|(?:(?<![\w@$|+!.-])|(?<=[_.-])(?![^\s@]{{0,64}}@[\w-]+\.\w)){DISGUISED}"
)
#: Longest group of letters that counts as a syllable, and gap signs between groups.
SYLLABLE, _GAPS = 4, np.isin(np.arange(256), list(b" .-_*"))
#: Readings kept by a worker before it forgets them all.
MEMORY = 500_000


def symbol(char: str) -> int:
    c = char.lower()
    return ord(c) - 96 if "a" <= c <= "z" and len(c) == 1 else 27 if char.isalpha() else 0


class CharacterModel:
    """Interpolated character trigrams as a table of log probabilities."""

    def __init__(self, counts: np.ndarray):
        three = counts.reshape(SYMBOLS, SYMBOLS, SYMBOLS).astype(float)
        one = (three.sum((0, 1)) + 1) / (three.sum() + SYMBOLS)
        two = (three.sum(0) + SYMBOLS * one) / (three.sum(0).sum(1, keepdims=True) + SYMBOLS)
        self.log = np.log((three + SYMBOLS * two[None]) / (three.sum(2, keepdims=True) + SYMBOLS))
        self.table = self.log.tolist()
        self.known: dict[str, str] = {}
        self.surplus: dict[int, list[int]] = {}

    def gains(self, s: np.ndarray, at: np.ndarray) -> np.ndarray:
        """What the text gains when the gaps at these places of its symbols are left out."""
        w, x, y, z = s[at - 2], s[at - 1], s[at + 1], s[at + 2]
        return self.log[w, x, y] + self.log[x, y, z] + APART - self.log[w, x, 0] - self.log[x, 0, y] - self.log[0, y, z]

    def word(self, text: str) -> float:
        before = (0, 0)
        total = 0.0
        for s in [*map(symbol, text), 0]:
            total += self.table[before[0]][before[1]][s]
            before = (before[1], s)
        return total

    def decode(self, observed: str) -> tuple[str, float]:
        """The likeliest reading of a disguised place and its log probability, by Viterbi over the last two symbols."""
        apart = APART_PLACE.fullmatch(observed) is not None
        units = [(m[0], len(m[0])) for m in re.finditer(r"(.)\1*", observed, re.S)]
        best = {(0, 0): (0.0, "")}
        for run, n in units:
            char = run[0]
            readings: list[tuple[str, float]] = []
            if apart and char in " .-_*":
                readings = [("", APART * n)]
            elif char.isalpha():
                readings = [(run, 0.0)] if n == 1 else [(char, REPEATED), (char * 2, REPEATED if n > 2 else 0.0)]
            else:
                readings = [(char, AS_SIGN * n)]
                if char in LOOK_ALIKES:
                    share = AS_LETTER - np.log(len(LOOK_ALIKES[char]))
                    readings += [(c * k, share * n + (REPEATED if k < n else 0.0)) for c in LOOK_ALIKES[char] for k in {min(n, 2), 1}]
            after: dict[tuple[int, int], tuple[float, str]] = {}
            for (a, b), (value, text) in best.items():
                for reading, cost in readings:
                    x, y, total = a, b, value + cost
                    for c in reading:
                        s = symbol(c)
                        total += self.table[x][y][s]
                        x, y = y, s
                    if (x, y) not in after or (total, text + reading) > after[x, y]:
                        after[x, y] = (total, text + reading)
            best = after
        ends = [(value + self.table[a][b][0], text) for (a, b), (value, text) in best.items()]
        value, text = max(ends)
        return text, value

    def as_it_stands(self, observed: str) -> float:
        """Log probability that a place says what it shows."""
        total, letters = 0.0, ""
        for c in observed + " ":
            if c.isalpha():
                letters += c
            else:
                total += (self.word(letters) if letters else 0.0) + (AS_SIGN if c in LOOK_ALIKES else 0.0)
                letters = ""
        return total

    def reading(self, observed: str) -> str:
        """A place as it is read: the likeliest reading where it gains enough."""
        if observed not in self.known:
            if len(self.known) >= MEMORY:
                self.known.clear()
            found, value = self.decode(observed)
            self.known[observed] = found if found != observed and value > self.as_it_stands(observed) + GAIN else observed
        return self.known[observed]

    def restore(self, text: str) -> str:
        read = SUSPECT.sub(lambda m: self.reading(m[0]), text)
        return _closed(pa.array([read], pa.large_string()), self)[0].as_py()


def trigram_counts(docs: DataFrame, text: str = "text") -> np.ndarray:
    """Character trigrams over every whole text: at most ``SYMBOLS`` cubed sums reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SYMBOLS**3, np.int64)
        for batch in batches:
            for r in bytetext.runs(batch.column(0)):
                s = _SYMBOL_OF_BYTE[r.data[(r.data < 128) | (r.data >= 192)]]
                s = np.concatenate([[0, 0], s, [0]])
                total += np.bincount((s[:-2] * SYMBOLS + s[1:-1]) * SYMBOLS + s[2:], minlength=len(total))
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["gram", "n"])

    rows = docs.select(text).mapInArrow(run, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    counts = np.zeros(SYMBOLS**3, np.int64)
    for r in rows.toLocalIterator():
        counts[r.gram] = r.n
    return counts


def _surplus_letters(run: bytetext.Run, model: CharacterModel) -> np.ndarray:
    """Places of letters of a-z that repeat the one before and are left out; each word is decoded once per worker."""
    low = run.data | 32
    twice = np.flatnonzero((low[1:] == low[:-1]) & (low[1:] >= 97) & (low[1:] <= 122) & _LETTER_BYTE[run.data[1:]] & _LETTER_BYTE[run.data[:-1]])
    w = bytetext.words(run, ~_LETTER_BYTE)
    of = np.unique(np.searchsorted(w.starts, twice, "right") - 1)
    hashes, first, back = np.unique(w.hashes[of], return_index=True, return_inverse=True)
    order = np.argsort(back, kind="stable")
    upto = np.concatenate([[0], np.cumsum(np.bincount(back, minlength=len(hashes)))])
    out = [np.zeros(0, int)]
    for k, (h, f) in enumerate(zip(hashes.tolist(), of[first].tolist(), strict=True)):
        if h not in model.surplus:
            if len(model.surplus) >= MEMORY:
                model.surplus.clear()
            word = run.data[w.starts[f] : w.ends[f]].tobytes().decode("utf-8", "replace").lower()
            model.surplus[h] = _left_out(word, model.reading(word))
        if model.surplus[h]:
            starts = w.starts[of[order[upto[k] : upto[k + 1]]]]
            out += [starts + j for j in model.surplus[h]]
    return np.concatenate(out)


def _left_out(word: str, read: str) -> list[int]:
    """Byte places of a word's letters that its reading leaves out; the reading repeats no letter more often."""
    out, at, k = [], 0, 0
    for c in word:
        if k < len(read) and read[k] == c:
            k += 1
        else:
            out.append(at)
        at += len(c.encode())
    return out


def _open_gaps(run: bytetext.Run, model: CharacterModel) -> np.ndarray:
    """Places of single gap signs between groups of at most ``SYLLABLE`` letters of a-z where the text gains without the gap.

    Only the symbols two places to either side tell, so each gap of the lattice is decided by itself.
    """
    place = np.arange(len(run.data)) + 3 * np.repeat(np.arange(1, len(run.offsets)), np.diff(run.offsets))
    data = np.zeros(len(run.data) + 3 * len(run.offsets), np.uint8)  # three zeros between texts
    data[place] = run.data
    s = _SYMBOL_OF_BYTE[data]
    inside = (s > 0) & (s < 27)
    at = np.flatnonzero(_GAPS[data[1:-1]] & inside[:-2] & inside[2:]) + 1
    edge = np.flatnonzero(~inside)
    k = np.searchsorted(edge, at)
    at = at[(at - edge[k - 1] <= SYLLABLE + 1) & (edge[k + 1] - at <= SYLLABLE + 1)]
    return np.searchsorted(place, at[model.gains(s, at) > GAIN])


def _closed(column: pa.Array, model: CharacterModel) -> pa.Array:
    """Texts without surplus letters and without gaps inside words; nulls become empty."""
    parts = []
    for r in bytetext.runs(column):
        keep = np.ones(len(r.data), bool)
        keep[_surplus_letters(r, model)] = False
        keep[_open_gaps(r, model)] = False
        offsets = np.concatenate([[0], np.cumsum(keep)])[r.offsets]
        parts.append(pa.LargeStringArray.from_buffers(len(offsets) - 1, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(r.data[keep].tobytes())))
    return pa.concat_arrays(parts) if parts else column


def _suspects(run: bytetext.Run) -> np.ndarray:
    """Numbers of the texts of a run that have a place to decode."""
    data = run.data
    if len(data) < 4:
        return np.arange(run.last - run.first)
    letter, sign = _LETTER_BYTE[data], _SIGN_BYTE[data]
    flag = np.zeros(len(data), bool)
    flag[:-1] |= sign[:-1] & letter[1:]
    flag[1:] |= sign[1:] & letter[:-1]
    flag[2:] |= letter[2:] & (data[2:] == data[1:-1]) & (data[1:-1] == data[:-2])
    starts = (data < 128) | (data >= 192)
    chars = np.flatnonzero(starts)
    kinds = letter[chars] | sign[chars]
    alone = np.flatnonzero(kinds & ~np.roll(kinds, 1) & ~np.roll(kinds, -1))
    near = alone[2:] - alone[:-2] <= 8  # three units with at most three gap signs between two
    flag[chars[alone[2:][near]]] = True
    return np.unique(np.searchsorted(run.offsets, np.flatnonzero(flag), "right") - 1)


def restored_texts(column: pa.Array, model: CharacterModel) -> pa.Array:
    """Texts with disguised places restored; a null stays null."""
    changed: dict[int, str] = {}
    for r in bytetext.runs(column):
        for k in _suspects(r):
            text = column[r.first + int(k)].as_py()
            if text:
                read = SUSPECT.sub(lambda m: model.reading(m[0]), text)
                if read != text:
                    changed[r.first + int(k)] = read
    read = column.cast(pa.large_string())
    if changed:
        values = column.to_pylist()
        for k, v in changed.items():
            values[k] = v
        read = pa.array(values, pa.large_string())
    closed = _closed(read, model)
    return pc.if_else(column.is_valid(), closed, pa.scalar(None, pa.large_string()))


def both_texts(column: pa.Array, model: CharacterModel) -> pa.Array:
    """What texts show and, behind a line break, what they are restored to."""
    column = column.cast(pa.large_string())
    return pc.binary_join_element_wise(column, restored_texts(column, model), pa.scalar("\n", pa.large_string()))


def word_features(run: bytetext.Run) -> tuple[np.ndarray, np.ndarray]:
    """(text number, feature) of every word and word beginning; the lowest bits of a feature tell its length."""
    w = bytetext.words(run, ~_LETTER_BYTE)
    hashes, owner, length = bytetext.RollingHash(run), w.text_of(), w.ends - w.starts
    low = np.uint64(15)
    out = [(owner, w.hashes & ~low | np.uint64(WHOLE))]
    for n in PREFIXES:
        has = length > n
        starts = w.starts[has]
        out.append((owner[has], hashes.spans(starts, starts + n) & ~low | np.uint64(n)))
    return np.concatenate([o for o, _ in out]), np.concatenate([f for _, f in out])


class Lexicon(NamedTuple):
    features: np.ndarray  # ascending
    precisions: np.ndarray
    base: float

    def scores(self, column: pa.Array) -> np.ndarray:
        innocent = np.full(len(column), np.log1p(-self.base))
        for r in bytetext.runs(column):
            owner, feature = word_features(r)
            if not len(feature) or not len(self.features):
                continue
            at = np.minimum(np.searchsorted(self.features, feature), len(self.features) - 1)
            hit = self.features[at] == feature
            pairs = np.unique(np.stack([owner[hit], at[hit]]), axis=1)
            np.add.at(innocent, r.first + pairs[0], np.log1p(-self.precisions[pairs[1]]))
        return -np.expm1(innocent)


def learn_lexicon(docs: DataFrame, labels: DataFrame, model: CharacterModel) -> Lexicon:
    """The lexicon from a bounded sample of labelled rows, taken by the hash of their id."""
    known = labels.select("doc_id", F.col("toxic").cast("int").alias("label"))
    known = known.filter(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull() & ~in_fold("doc_id", FOLDS, HELD_OUT))
    shares = {r.label: r["count"] for r in known.groupBy("label").count().collect()}
    if not shares.get(1):
        return Lexicon(np.zeros(0, np.uint64), np.zeros(0), 0.0)
    prior = shares[1] / sum(shares.values())
    # ids with a hash under a bound that about twice the sample meets, so that few rows are ordered
    share = F.element_at(F.create_map(*[F.lit(x) for k, n in shares.items() for x in (k, min(1.0, 2 * PER_CLASS / n))]), F.col("label"))
    near = known.withColumn("place", F.xxhash64("doc_id")).filter(F.col("place") / 2.0**64 + 0.5 <= share)
    by_hash = Window.partitionBy("label").orderBy("place", "doc_id")
    chosen = near.withColumn("place", F.row_number().over(by_hash)).filter(F.col("place") <= PER_CLASS)
    chosen = chosen.groupBy("doc_id").agg(F.max("label").alias("label"))  # at most PER_CLASS of either label

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = both_texts(batch.column(2), model)
            for r in bytetext.runs(column):
                owner, feature = word_features(r)
                pairs = np.unique(np.stack([owner.astype(np.uint64), feature]), axis=1)
                rows = pa.array(pairs[0].astype(np.int64) + r.first)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(rows), batch.column(1).take(rows), pa.array(pairs[1].view(np.int64))],
                    names=["doc_id", "label", "feature"],
                )

    sample = docs.join(F.broadcast(chosen), "doc_id").select(F.col("doc_id").cast("long").alias("doc_id"), "label", "text")
    sample = settle(sample.dropDuplicates(["text"]), "toxicity-sample")
    n = {r.label: r["count"] for r in sample.groupBy("label").count().collect()}
    rows = sample.mapInArrow(cut, "doc_id long, label int, feature long")
    toxic, clean = n.get(1, 0), max(n.get(0, 0), 1)
    least = max(LEAST_DOCUMENTS, LEAST_SHARE * toxic)
    wrong = F.col("clean") / clean * (1 - prior)
    right = F.col("toxic") / max(toxic, 1) * prior
    counted = rows.groupBy("feature").agg(F.sum("label").alias("toxic"), F.sum(1 - F.col("label")).alias("clean"))
    counted = counted.filter((F.col("toxic") >= least) & (right >= LEAST_PRECISION * (right + wrong)))
    counted = settle(counted, "toxicity-candidates")
    held = rows.filter("label = 1").join(counted, "feature").select("doc_id", "feature", "clean")
    # bounded by the sample: toxic documents of the sample with their candidate entries
    table = held.toArrow()
    docs_of, feature, wrongs = (table[c].to_numpy() for c in ("doc_id", "feature", "clean"))
    return _cover(docs_of, feature.view(np.uint64), wrongs, toxic, clean, prior, least)


def _cover(docs_of, feature, wrongs, toxic: int, clean: int, prior: float, least: float) -> Lexicon:
    """Takes entries greedily until none explains enough of the documents left."""
    order = np.lexsort((docs_of, feature))
    docs_of, feature, wrongs = np.unique(docs_of, return_inverse=True)[1][order], feature[order], wrongs[order]
    names, first, index = np.unique(feature, return_index=True, return_inverse=True)
    counts, clean_of = np.bincount(index, minlength=len(names)), wrongs[first] if len(feature) else wrongs
    left = np.ones(int(docs_of.max()) + 1 if len(docs_of) else 0, bool)
    taken: list[int] = []
    while len(names):
        gain = np.bincount(index, left[docs_of], len(names)).astype(int)
        # of entries that explain as much, the longest; a whole word last of those of its length
        specific = (names & np.uint64(15)).astype(int) % WHOLE
        best = int(np.lexsort((names, -specific, -gain))[0])
        if gain[best] < least:
            break
        taken.append(best)
        left[docs_of[index == best]] = False
    taken = np.array(sorted(taken, key=lambda k: names[k]), int)
    right = (counts[taken] + 0.5) / (toxic + 1) * prior
    wrong = (clean_of[taken] + 0.5) / (clean + 1) * (1 - prior)
    unexplained = (toxic - (len(left) - left.sum())) / max(toxic, 1) * prior
    return Lexicon(names[taken], right / (right + wrong), min(0.25, float(unexplained)))


def restore_texts(docs: DataFrame, model: CharacterModel, text: str = "text", restored: str = "restored") -> DataFrame:
    """Adds every whole text with its disguised places restored; a null text stays null."""
    out = docs.drop(restored)
    schema = T.StructType([*out.schema.fields, T.StructField(restored, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(text))
            yield batch.append_column(restored, restored_texts(column, model).cast(pa.string()))

    return out.mapInArrow(run, schema)


def toxicity_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted.

    Labels other than 0 and 1 and null ids teach nothing; a document labelled both ways counts as toxic.  Null and empty texts
    have the score of a text without entries.  Repeated rows stay; empty tables give an empty result.
    """
    model = CharacterModel(trigram_counts(docs))
    lexicon = learn_lexicon(docs, labels, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = lexicon.scores(both_texts(batch.column(1), model))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores)], names=["doc_id", "score"])

    schema = T.StructType([docs.schema["doc_id"], T.StructField("score", T.DoubleType())])
    return docs.select("doc_id", "text").mapInArrow(run, schema).select(
        "doc_id", in_fold("doc_id", FOLDS, HELD_OUT).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )
