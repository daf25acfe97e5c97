"""Language identification by interpolated Kneser-Ney character trigrams."""

import unicodedata
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlewright.llm.common import per_worker

UNKNOWN = "und"
ROWS_PER_LANGUAGE = 400  # labelled rows the models are fitted on
SAMPLE_ROWS = 20_000  # of all languages together
CHUNK = 1 << 20  # characters scored at a time
SURE_LENGTH = 20.0  # characters that count as independent evidence in the score
SPACE = 32
BITS = 21  # of a code point; three make a trigram's key


def letters() -> np.ndarray:
    heads = "".join(unicodedata.category(chr(c))[0] for c in range(0x110000))
    return np.frombuffer(heads.encode(), np.uint8) == ord("L")


def symbols(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased letters with one space for whatever lies between, each text led by two spaces.

    Returns the code points, where each text begins, and how many letters it has.
    """
    led = ["\n\n" + t.lower() for t in texts]
    points = np.frombuffer("".join(led).encode("utf-32-le"), np.uint32)
    begins = np.cumsum([0, *map(len, led)])[:-1]
    letter = per_worker("letters", letters)[points]
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    keep[begins] = True
    keep[begins + 1] = True
    counts = np.add.reduceat(letter, begins, dtype=np.int64)
    at = np.concatenate([[0], np.cumsum(keep)])[begins]
    return np.where(letter, points, SPACE)[keep], at, counts


def hashed(keys: np.ndarray) -> np.ndarray:
    keys = keys.astype(np.uint64)
    keys = (keys ^ (keys >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    keys = (keys ^ (keys >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return keys ^ (keys >> np.uint64(31))


class HashArray:
    """Rows of values by sorted hash; the leading bits point into the array."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        hashes = hashed(keys)
        order = np.argsort(hashes)
        self.hashes, self.values = hashes[order], values[order]
        bits = max(1, int(len(keys)).bit_length() + 1)
        self.shift = np.uint64(64 - bits)
        self.first = np.searchsorted(self.hashes, np.arange(1 << bits, dtype=np.uint64) << self.shift)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Row of each key, or -1."""
        out = np.full(len(keys), -1, np.int64)
        if not len(self.hashes):
            return out
        wanted = hashed(keys)
        at = self.first[(wanted >> self.shift).astype(np.int64)]
        open_ = np.arange(len(keys))
        while len(open_):
            inside = at < len(self.hashes)
            open_, at, wanted = open_[inside], at[inside], wanted[inside]
            here = self.hashes[at]
            out[open_[here == wanted]] = at[here == wanted]
            more = here < wanted
            open_, at, wanted = open_[more], at[more] + 1, wanted[more]
        return out


def _grouped(keys: np.ndarray, weights: np.ndarray):
    """Distinct keys with summed weights and number of entries."""
    unique, inverse, counts = np.unique(keys, return_inverse=True, return_counts=True)
    return unique, np.bincount(inverse, weights=weights, minlength=len(unique)), counts


def _discount(counts: np.ndarray) -> float:
    once, twice = (counts == 1).sum(), (counts == 2).sum()
    return float(once / (once + 2 * twice)) if once else 0.5


def _looked_up(keys, values, wanted, default):
    at = np.minimum(np.searchsorted(keys, wanted), max(0, len(keys) - 1))
    return np.where(keys[at] == wanted, values[at], default) if len(keys) else np.full(len(wanted), default)


LOW = (1 << BITS) - 1


class KneserNey:
    """One language: interpolated probabilities of trigrams packed in integers."""

    def __init__(self, grams: np.ndarray, counts: np.ndarray, alphabet: int):
        self.grams, self.counts = grams, counts.astype(float)
        self.d3 = _discount(counts)
        self.contexts, self.context_sum, self.context_types = _grouped(grams >> BITS, self.counts)
        pairs, self.pair_counts, _ = _grouped(grams & ((1 << 2 * BITS) - 1), np.ones(len(grams)))
        self.pairs, self.d2 = pairs, _discount(self.pair_counts)
        self.lefts, self.left_sum, self.left_types = _grouped(pairs >> BITS, self.pair_counts)
        self.singles, self.single_counts, _ = _grouped(pairs & LOW, np.ones(len(pairs)))
        self.d1, self.total = _discount(self.single_counts), self.single_counts.sum()
        self.base = self.d1 * len(self.singles) / self.total / alphabet

    def single(self, w):
        count = _looked_up(self.singles, self.single_counts, w, 0.0)
        return np.maximum(count - self.d1, 0) / self.total + self.base

    def left_weight(self, b):
        return _looked_up(self.lefts, self.d2 * self.left_types / self.left_sum, b, 1.0)

    def pair(self, bw):
        b = bw >> BITS
        count = _looked_up(self.pairs, self.pair_counts, bw, 0.0)
        total = _looked_up(self.lefts, self.left_sum, b, 1.0)
        return np.maximum(count - self.d2, 0) / total + self.left_weight(b) * self.single(bw & LOW)

    def context_weight(self, ab):
        return _looked_up(self.contexts, self.d3 * self.context_types / self.context_sum, ab, 1.0)

    def gram(self, abw):
        ab = abw >> BITS
        count = _looked_up(self.grams, self.counts, abw, 0.0)
        total = _looked_up(self.contexts, self.context_sum, ab, 1.0)
        return np.maximum(count - self.d3, 0) / total + self.context_weight(ab) * self.pair(abw & ((1 << 2 * BITS) - 1))


@dataclass
class Model:
    """Log probabilities of all languages side by side, and when to reject."""

    languages: list[str]
    grams: HashArray
    contexts: HashArray
    pairs: HashArray
    lefts: HashArray
    singles: HashArray
    unseen: np.ndarray
    typical: np.ndarray | None = None
    margin: np.ndarray | None = None
    spread: float = 1.5

    def log_probabilities(self, keys: np.ndarray) -> np.ndarray:
        row = self.grams.find(keys)
        out = self.grams.values[row]
        missed = np.flatnonzero(row < 0)
        if len(missed):
            key = keys[missed]
            found = self.contexts.find(key >> BITS)
            weight = np.where(found[:, None] >= 0, self.contexts.values[found], 0.0)
            low = key & ((1 << 2 * BITS) - 1)
            pair = self.pairs.find(low)
            value = self.pairs.values[pair]
            rare = np.flatnonzero(pair < 0)
            if len(rare):
                left, single = self.lefts.find(low[rare] >> BITS), self.singles.find(low[rare] & LOW)
                value[rare] = np.where(left[:, None] >= 0, self.lefts.values[left], 0.0) + np.where(
                    single[:, None] >= 0, self.singles.values[single], self.unseen
                )
            out[missed] = weight + value
        return out

    def scores(self, texts: list[str]):
        """Per text: cross-entropy under each language (nats a character), characters, letters."""
        points, at, n_letters = symbols(texts)
        points = points.astype(np.int64)
        keys = (points[:-2] << 2 * BITS) | (points[1:-1] << BITS) | points[2:]
        logs = np.zeros((len(points), len(self.languages)))
        logs[2:] = self.log_probabilities(keys)
        logs[at] = 0
        logs[at + 1] = 0
        sizes = np.diff(np.append(at, len(points))) - 2
        return -np.add.reduceat(logs, at, axis=0) / np.maximum(sizes, 1)[:, None], sizes, n_letters

    def predict(self, texts: list[str]):
        """Language, score, cross-entropy and rejection of each text."""
        entropy, sizes, n_letters = self.scores(texts)
        best = entropy.argmin(axis=1)
        least = entropy[np.arange(len(texts)), best]
        apart = (entropy - least[:, None]) * np.minimum(sizes, SURE_LENGTH)[:, None]
        score = 1 / np.exp(-apart).sum(axis=1)
        limit = self.typical[best] + 3 * self.margin[best] + 6 * self.spread / np.sqrt(np.maximum(sizes, 1))
        none = n_letters == 0
        names = [UNKNOWN if e else self.languages[b] for e, b in zip(none, best, strict=True)]
        return names, np.where(none, 0.0, score), least, none | (least > limit)


def _model(languages: list[str], tables: list[tuple[np.ndarray, np.ndarray]]) -> Model:
    alphabet = len(np.unique(np.concatenate([np.unique(g & LOW) for g, _ in tables]))) + 1
    own = [KneserNey(g, c, alphabet) for g, c in tables]

    def union(part, value):
        keys = np.unique(np.concatenate([part(m) for m in own]))
        return HashArray(keys, np.log(np.stack([value(m, keys) for m in own], axis=1)))

    return Model(
        languages,
        union(lambda m: m.grams, KneserNey.gram),
        union(lambda m: m.contexts, KneserNey.context_weight),
        union(lambda m: m.pairs, KneserNey.pair),
        union(lambda m: m.lefts, KneserNey.left_weight),
        union(lambda m: m.singles, KneserNey.single),
        np.log([m.base for m in own]),
    )


def _chunks(texts: list[str]):
    start, size = 0, 0
    for i, text in enumerate(texts):
        if size and size + len(text) > CHUNK:
            yield start, i
            start, size = i, 0
        size += len(text)
    if texts:
        yield start, len(texts)


def held_out(id_col="doc_id") -> Column:
    """Rows that nothing is learned from: a quarter by crc32 of the id, and rows without one."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(True))


def fit(
    docs: DataFrame, id_col="doc_id", text_col="text", lang_col="lang",
    rows_per_language: int = ROWS_PER_LANGUAGE, sample_rows: int = SAMPLE_ROWS,
) -> Model | None:
    """Models of every language among the labelled rows that are not held out; None without any.

    They are fitted on whole texts of at most ``rows_per_language`` rows a language, the first by a
    hash of the id, and ``sample_rows`` in all: what reaches the driver is bounded by their trigrams.
    Every fifth of these rows is kept apart to find how far from the typical cross-entropy a text of
    the language may lie.
    """
    usable = docs.select(
        F.col(id_col).alias("id"), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"), held_out(id_col).alias("out")
    ).where("NOT out AND lang IS NOT NULL AND text IS NOT NULL")
    order = F.xxhash64("id")
    ranked = usable.select("id", "lang").distinct().withColumn(
        "nth", F.row_number().over(Window.partitionBy("lang").orderBy(order, "id"))
    ).where(F.col("nth") <= rows_per_language)
    chosen = ranked.orderBy("nth", "lang").limit(sample_rows)
    sample = usable.join(F.broadcast(chosen), ["id", "lang"]).select("lang", "text", (F.col("nth") % 5 == 0).alias("apart"))

    def count(batches):
        for batch in batches:
            langs, texts, apart = (batch.column(k).to_pylist() for k in range(3))
            for lang in set(langs):
                mine = [t for t, name, a in zip(texts, langs, apart, strict=True) if name == lang and not a]
                for a, b in _chunks(mine):
                    points, at, _ = symbols(mine[a:b])
                    points = points.astype(np.int64)
                    keys = (points[:-2] << 2 * BITS) | (points[1:-1] << BITS) | points[2:]
                    inside = np.ones(len(points), bool)
                    inside[at] = inside[at + 1] = False
                    grams, n = np.unique(keys[inside[2:]], return_counts=True)
                    yield pa.record_batch([pa.array([lang] * len(grams), pa.string()), pa.array(grams), pa.array(n)], names=["lang", "gram", "n"])

    counted = sample.mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")).toPandas()
    if counted.empty:
        return None
    tables = []
    languages = sorted(counted["lang"].unique())
    for lang in languages:
        mine = counted[counted["lang"] == lang].sort_values("gram")
        tables.append((mine["gram"].to_numpy(), mine["n"].to_numpy()))
    model = _model(languages, tables)
    model.typical, model.margin = _calibrated(model, sample)
    return model


def _calibrated(model: Model, sample: DataFrame):
    """Mean cross-entropy of each language and the largest excess over it, on rows kept apart."""
    shared = sample.sparkSession.sparkContext.broadcast(model)

    def measure(batches):
        for batch in batches:
            texts = [t for t, a in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True) if a]
            langs = [t for t, a in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True) if a]
            for a, b in _chunks(texts):
                entropy, sizes, _ = shared.value.scores(texts[a:b])
                own = [model_index[lang] for lang in langs[a:b]]
                value = entropy[np.arange(b - a), own]
                yield pa.record_batch([pa.array(langs[a:b], pa.string()), pa.array(value), pa.array(sizes)], names=["lang", "entropy", "size"])

    model_index = {lang: k for k, lang in enumerate(model.languages)}
    known = F.col("lang").isin(model.languages)
    found = sample.where(known).mapInArrow(measure, "lang string, entropy double, size long")
    rows = found.where("size >= 100").groupBy("lang").agg(
        F.avg("entropy").alias("typical"), (F.max("entropy") - F.avg("entropy")).alias("margin")
    ).collect()
    by = {r.lang: (r.typical, r.margin) for r in rows}
    general = (max((v[0] for v in by.values()), default=8.0), max((v[1] for v in by.values()), default=1.0))
    pairs = [by.get(lang, general) for lang in model.languages]
    return np.array([p[0] for p in pairs]), np.maximum(np.array([p[1] for p in pairs]), 0.25)


def identify(docs: DataFrame, model: Model | None, carried: Column, text_col="text") -> DataFrame:
    """``carried`` (a struct, as column row) with lang_pred, score, cross_entropy and rejected of every row.

    The language of least cross-entropy per character over the whole text. A null text or one without
    letters is ``und`` with score 0 and rejected. If nothing was learned all texts are ``und`` with score 0, but only
    those without letters are rejected: no language was there to judge the others by. ``rejected``
    marks texts that no language explains: cross-entropy above the language's typical one by three times the
    largest excess seen in calibration and six deviations of a text of that length. Rows are
    independent of each other, so nothing is shuffled; other columns are not read.
    """
    kept = docs.select(carried.alias("row"), F.col(text_col).cast("string").alias("text"))
    schema = f"row {kept.schema['row'].dataType.simpleString()}, lang_pred string, score double, cross_entropy double, rejected boolean"
    if model is None:
        # The letters of Python's Unicode tables, as with a model.
        def unjudged(batches):
            for batch in batches:
                texts = [t or "" for t in batch.column(1).to_pylist()]
                for a, b in _chunks(texts):
                    n = b - a
                    none = symbols(texts[a:b])[2] == 0
                    yield pa.record_batch(
                        [batch.column(0).slice(a, n), pa.array([UNKNOWN] * n), pa.array([0.0] * n), pa.nulls(n, pa.float64()), pa.array(none)],
                        names=["row", "lang_pred", "score", "cross_entropy", "rejected"],
                    )

        return kept.mapInArrow(unjudged, schema)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def rows(batches):
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for a, b in _chunks(texts):
                names, score, entropy, rejected = shared.value.predict(texts[a:b])
                yield pa.record_batch(
                    [batch.column(0).slice(a, b - a), pa.array(names), pa.array(score), pa.array(entropy), pa.array(rejected)],
                    names=["row", "lang_pred", "score", "cross_entropy", "rejected"],
                )

    return kept.mapInArrow(rows, schema)
