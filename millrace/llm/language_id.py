"""Language identification by hyperdimensional profiles.

Every letter has a random vector of +1 and -1.  An n-gram of letters is the product of its letters'
vectors, each rotated by its place (permute and bind); a text is the sum of its n-grams (bundle).  The sum
over a language's training texts is its prototype, and a text goes to the prototype of largest cosine.

Letters come from a fixed alphabet of 64: a to z, the break between words, and 37 codes into which all
other letters are hashed; breaks in a row are one, and every text begins and ends with one.  A long text is read
in pieces that hand on their last two letters, so it gives the n-grams it would give as a whole.

The n-grams of a slice of texts are counted at once, and one matrix product bundles all of them.  Each task
bundles the training texts it reads into one vector per language, so a few numbers per language are summed and
collected, whatever the size of the corpus; more than ``LANGUAGES`` distinct values are refused, as they are no
languages.  Prototypes are centred on their mean before they are compared, as are the texts: what all languages
share does not count.

Defined results: ``und`` with score 0 for null text and text without letters; ties go to the language that
sorts first; without training texts every text is ``und``; repeated rows count as often as they occur; bytes
that are not UTF-8 are breaks or letters of their own, and never an error; equal texts have equal scores.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .core import SLICE_BYTES, slices, split_mod

DIMENSIONS = 512
GRAM = 3
LETTERS = 64
GRAMS = LETTERS**GRAM
#: Most distinct values of the language column.
LANGUAGES = 4096
#: Texts whose n-gram counts are one matrix.
_TOGETHER = 128
_BREAK = 26
_SEED = 7919


def _hashed(c):
    return _BREAK + 1 + (c * 2654435761 >> 7) % (LETTERS - _BREAK - 1)


def _alphabet() -> np.ndarray:
    """Code of each character of the basic plane: a letter's, or the break."""
    codes = np.full(1 << 16, _BREAK, np.uint8)
    for c in range(1 << 16):
        ch = chr(c)
        if ch.isalpha():
            low = ord(ch.lower()[0])
            codes[c] = low - 97 if 97 <= low <= 122 else _hashed(low)
    return codes


def characters(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points of UTF-8 bytes, and the byte at which each begins."""
    at = np.flatnonzero((data & 0xC0) != 0x80)
    lead = data[at].astype(np.uint32)
    points = lead.copy()
    for size, low, high in ((2, 0xC0, 0xE0), (3, 0xE0, 0xF0), (4, 0xF0, 0x100)):
        which = np.flatnonzero((lead >= low) & (lead < high))
        if len(which):
            value = lead[which] & (0x7F >> size)
            for k in range(1, size):
                value = value << 6 | (data[np.minimum(at[which] + k, len(data) - 1)] & 0x3F)
            points[which] = value
    return points, at


class Space:
    """The vectors of letters at each place of an n-gram, and texts as counts of n-grams and as vectors."""

    _made: "Space | None" = None

    def __init__(self, dimensions: int = DIMENSIONS) -> None:
        self.codes = _alphabet()
        self.dimensions = dimensions
        letters = np.random.default_rng(_SEED).choice(np.array([-1, 1], np.int8), (LETTERS, dimensions))
        self.places = [np.roll(letters, GRAM - 1 - i, axis=1) for i in range(GRAM)]

    @classmethod
    def get(cls) -> "Space":
        cls._made = cls._made or cls()
        return cls._made

    def letters(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes of some bytes' characters, and where each begins."""
        points, at = characters(data)
        codes = self.codes[np.minimum(points, 0xFFFF)]
        for i in np.flatnonzero(points > 0xFFFF):
            codes[i] = _hashed(int(points[i])) if points[i] < 0x110000 and chr(points[i]).isalpha() else _BREAK
        return codes, at

    def grams(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """N-grams of a slice's texts in order, and the text of each."""
        codes, at = self.letters(data)
        n = len(offsets) - 1
        size = np.diff(np.searchsorted(at, offsets))
        # A break in front of every text and one behind it.
        text = np.repeat(np.arange(n, dtype=np.int32), size + 2)
        whole = np.full(len(text), _BREAK, np.uint8)
        whole[np.arange(len(codes)) + np.repeat(2 * np.arange(n) + 1, size)] = codes
        is_break = whole == _BREAK
        keep = np.ones(len(whole), bool)
        keep[1:] = ~(is_break[1:] & is_break[:-1] & (text[1:] == text[:-1]))
        return self._keys(whole[keep].astype(np.int32), text[keep])

    @staticmethod
    def _keys(codes: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n = len(codes) - GRAM + 1
        if n <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        key = codes[:n].copy()
        for i in range(1, GRAM):
            key = key * LETTERS + codes[i : n + i]
        inside = text[:n] == text[GRAM - 1 :]
        return key[inside], text[:n][inside]

    def counts_of_long(self, data: np.ndarray, piece: int = SLICE_BYTES) -> np.ndarray:
        """How often each n-gram occurs in one text of any length (``piece``: 4 bytes or more)."""
        total, carry, at = np.zeros(GRAMS, np.int64), np.array([_BREAK]), 0
        while at <= len(data):
            end = min(at + piece, len(data))
            while end < len(data) and data[end] & 0xC0 == 0x80 and end > at + 1:
                end -= 1
            codes = np.concatenate([carry, self.letters(data[at:end])[0], [_BREAK] if end == len(data) else []]).astype(np.int64)
            is_break = codes == _BREAK
            codes = codes[~(is_break & np.concatenate([[False], is_break[:-1]]))]
            total += np.bincount(self._keys(codes, np.zeros(len(codes), np.int64))[0], minlength=GRAMS)
            carry, at = codes[-(GRAM - 1) :], end if end < len(data) else end + 1
        return total

    def vectors(self, keys: np.ndarray, kind=np.float32) -> np.ndarray:
        """The bound vector of each n-gram."""
        bound = None
        for i, place in enumerate(self.places):
            letter = place[keys // LETTERS ** (GRAM - 1 - i) % LETTERS]
            bound = letter if bound is None else bound * letter
        return bound.astype(kind)

    def bundle(self, keys: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Sum of the vectors of ``keys``, each ``counts`` times; a row per row of ``counts``.  The sums are whole numbers
        and exact: in single precision up to 2^24 n-grams, beyond in double precision (up to 2^53)."""
        kind = np.float32 if not counts.size or counts.sum(axis=-1).max() < 1 << 24 else np.float64
        out = np.zeros((*counts.shape[:-1], self.dimensions), np.float64)
        for a in range(0, len(keys), 4096):
            out += counts[..., a : a + 4096].astype(kind) @ self.vectors(keys[a : a + 4096], kind)
        return out

    def texts(self, s) -> np.ndarray:
        """The vector of each text of a slice; zero where there is no letter."""
        out = np.zeros((len(s), self.dimensions))
        if len(s) == 1 and len(s.data) > SLICE_BYTES:
            total = self.counts_of_long(s.data)
            keys = np.flatnonzero(total)
            out[0] = self.bundle(keys, total[keys])
            return out
        grams, text = self.grams(s.data, s.offsets)
        used = np.flatnonzero(np.bincount(grams, minlength=1))
        column = np.zeros(GRAMS, np.int32)
        column[used] = np.arange(len(used))
        column = column[grams]
        cut = np.searchsorted(text, np.arange(0, len(s) + _TOGETHER, _TOGETHER))
        for k, (a, z) in enumerate(zip(cut, cut[1:], strict=False)):
            rows = min(_TOGETHER, len(s) - k * _TOGETHER)
            counts = np.bincount((text[a:z] - k * _TOGETHER) * len(used) + column[a:z], minlength=rows * len(used))
            out[k * _TOGETHER : k * _TOGETHER + rows] = self.bundle(used, counts.reshape(rows, len(used)))
        return out


def _bundle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    space = Space.get()
    total: dict[str, np.ndarray] = {}
    count: dict[str, np.ndarray] = {}
    for batch in batches:
        for s in slices(batch.column("text")):
            langs = batch.column("lang").slice(s.row, len(s)).dictionary_encode()
            index = langs.indices.to_numpy(zero_copy_only=False)
            if len(s) == 1:
                of_lang = [space.counts_of_long(s.data)]
            else:
                grams, text = space.grams(s.data, s.offsets)
                of_lang = [np.bincount(grams[index[text] == i], minlength=GRAMS) for i in range(len(langs.dictionary))]
            for lang, n in zip(langs.dictionary.to_pylist(), of_lang, strict=True):
                if n.any():
                    count[lang] = count[lang] + n if lang in count else n
            if len(count) > 32:  # bounded: fold the counts of many languages into their vectors
                _fold(space, total, count)
    _fold(space, total, count)
    for lang, v in total.items():
        yield pa.record_batch({"lang": pa.array([lang] * len(v)), "place": pa.array(np.arange(len(v), dtype=np.int32)), "value": pa.array(v)})


def _fold(space: Space, total: dict[str, np.ndarray], count: dict[str, np.ndarray]) -> None:
    for lang, n in count.items():
        keys = np.flatnonzero(n)
        total[lang] = total.get(lang, 0) + space.bundle(keys, n[keys])
    count.clear()


def learn_prototypes(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", most: int = LANGUAGES) -> tuple[list[str], np.ndarray]:
    """Languages in order, and their unit prototypes (one row each)."""
    train = docs.select(F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang")).where("text is not null and lang is not null")
    sums = train.mapInArrow(_bundle, "lang string, place int, value double").groupBy("lang", "place").agg(F.sum("value").alias("value"))
    sums = sums.limit(most * DIMENSIONS + 1).toPandas()
    if len(sums) > most * DIMENSIONS:
        raise ValueError(f"column {lang_col} holds more than {most} values: these are no languages")
    langs = sorted(sums["lang"].unique())
    out = np.zeros((len(langs), DIMENSIONS))
    at = {x: i for i, x in enumerate(langs)}
    out[sums["lang"].map(at).to_numpy(int), sums["place"].to_numpy(int)] = sums["value"].to_numpy(float)
    return langs, out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-12)


class Judge:
    """Compares vectors of texts with the prototypes."""

    def __init__(self, langs: list[str], prototypes: np.ndarray) -> None:
        self.langs = np.array([*langs, "und"], object)
        self.middle = prototypes.mean(axis=0) if len(langs) > 1 else np.zeros(DIMENSIONS)
        centred = prototypes - self.middle
        self.centred = centred / np.maximum(np.linalg.norm(centred, axis=1, keepdims=True), 1e-12)

    def __call__(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Language and score of each row; ``und`` and 0 for a zero vector.  Vectors are whole numbers and each row is summed by
        itself, so equal texts have equal scores whatever lies beside them."""
        size = np.linalg.norm(vectors, axis=1, keepdims=True)
        known = (size[:, 0] > 0) & (len(self.langs) > 1)
        best, score = np.full(len(vectors), len(self.langs) - 1), np.zeros(len(vectors))
        if known.any():
            v = vectors[known] / size[known] - self.middle
            v = v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)
            cosine = np.round(np.stack([(v * own).sum(axis=1) for own in self.centred], axis=1), 10)
            best[known] = np.argmax(cosine, axis=1)
            score[known] = np.clip((1 + cosine.max(axis=1)) / 2, 0, 1)
        return self.langs[best], score


def _predict(langs: list[str], prototypes: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        space, judge = Space.get(), Judge(langs, prototypes)
        for batch in batches:
            for s in slices(batch.column("text")):
                lang, score = judge(space.texts(s))
                yield pa.record_batch({"row": batch.column("row").slice(s.row, len(s)), "lang_pred": pa.array(lang, pa.string()), "score": pa.array(score)})

    return run


def identify(docs: DataFrame, langs: list[str], prototypes: np.ndarray, text_col: str = "text") -> DataFrame:
    """One row per input row: ``row`` (all its columns), ``lang_pred`` and ``score``, the cosine moved to 0..1."""
    rows = docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("row"), F.col(text_col).alias("text"))
    schema = T.StructType([rows.schema["row"], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    return rows.mapInArrow(_predict(langs, prototypes), schema)


def op9_language_id(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    held_out = split_mod(F.col("doc_id"), 3) == 1
    model = learn_prototypes(docs.where(~held_out))
    out = identify(docs.select("doc_id", "text"), *model)
    return out.select(F.col("row.doc_id").alias("doc_id"), (split_mod(F.col("row.doc_id"), 3) == 1).alias("held_out"), "lang_pred", "score")
