"""Language identification with interpolated Kneser-Ney character models.

A text becomes lower-case letters with one space for everything between them. For each language the
training texts give the counts of all runs of four characters, summed over the cluster. From these come
the lower orders: the number of different characters seen before a run. A model is the table of
interpolated probabilities of all runs that any language has, with a column for each language; a run that no
language has backs off to three characters and so on.

Every run is kept. Tables of up to `STORED` runs are sorted hashes that go to every worker. Larger ones are
made and stay as Spark tables (`SparkTables`); the workers then get the most frequent runs only, and the
other runs of the texts are joined with the tables. Both ways give the same costs, up to rounding.

A text goes to the language with the lowest cross-entropy per character. The score is its share in a
softmax whose sharpness is calibrated on all training texts, and `rejected` marks texts whose best
cross-entropy is above nearly all of theirs. Losses are added up and the limit is found by counts in Spark.

Cases: a text that is null or has no letter gets `und` and score 0, as does every text if nothing was
learned. Rows with null text or null language teach nothing. Ties go to the language that sorts first.
Columns of the input whose names the result uses are replaced. An empty table gives an empty table.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridtide.session import cut

ORDER = 4
TOGETHER = 1_000_000  # characters that are looked up in one go
STORED = 1 << 21  # runs of four, of all languages together, up to which the tables go to every worker whole
CALIBRATION = 4_000  # rows of `calibration_rows`
SPACE, END = 32, 0  # END stands after each text
REJECT = 0.999  # share of the calibration texts that is not rejected
SHARPNESS = [2.0**k for k in range(-2, 8)]
BINS = 1_024  # of a pass that looks for a rank


@functools.cache
def letter_table() -> np.ndarray:
    """The code of each character of the basic plane: its lower-case letter, or a space."""
    table = np.full(1 << 16, SPACE, np.uint16)
    for c in range(1 << 16):
        if 0xD800 <= c < 0xE000:
            continue
        if chr(c).isalpha():
            low = chr(c).lower()
            table[c] = ord(low[0]) if ord(low[0]) < 1 << 16 else c
    return table


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def flatten(texts: list[str]) -> np.ndarray:
    """The codes of all texts, each between spaces and followed by END; no two spaces stand together.

    Letters beyond the basic plane share one code.
    """
    joined = "".join([f" {t} \0" for t in (t.replace("\0", " ") for t in texts)])
    wide = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4")
    codes = letter_table()[np.minimum(wide, 0xFFFF)]
    high = np.flatnonzero(wide > 0xFFFF)
    if len(high):
        codes[high] = [0xFFFE if chr(c).isalpha() else SPACE for c in wide[high].tolist()]
    codes[wide == 0] = END
    twice = np.zeros(len(codes), bool)
    twice[1:] = (codes[1:] == SPACE) & (codes[:-1] == SPACE)
    return codes[~twice]


def runs(codes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Runs of n characters inside one text as 64-bit keys, and where they begin."""
    if len(codes) < n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    key = codes[: len(codes) - n + 1].astype(np.uint64)
    whole = codes[: len(codes) - n + 1] != END
    for k in range(1, n):
        part = codes[k : len(codes) - n + 1 + k]
        key = key << np.uint64(16) | part
        whole &= part != END
    at = np.flatnonzero(whole)
    return key[at], at


def batches_of(texts: list[str]) -> Iterator[tuple[int, list[str]]]:
    """Slices of some million characters, each with the place of its first text; a text stays whole."""
    start, size = 0, 0
    for k, text in enumerate(texts):
        size += len(text)
        if size >= TOGETHER:
            yield start, texts[start : k + 1]
            start, size = k + 1, 0
    if start < len(texts):
        yield start, texts[start:]


def runs_of(texts: list[str]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """The runs that give the probabilities of all characters: their length, keys, and the ascending places of their texts."""
    codes = flatten(texts)
    ends = np.flatnonzero(codes == END)
    # the first characters of a text have shorter runs
    firsts = np.concatenate([[0], ends[:-1] + 1])
    for n in range(2, ORDER):
        has = np.flatnonzero(firsts + n <= ends)
        keys = np.zeros(len(has), np.uint64)
        for k in range(n):
            keys = keys << np.uint64(16) | codes[firsts[has] + k].astype(np.uint64)
        yield n, keys, has
    keys, at = runs(codes, ORDER)
    yield ORDER, keys, np.searchsorted(ends, at)


def _add(sums: np.ndarray, text: np.ndarray, values: np.ndarray) -> None:
    """Adds the rows of `values` to those of their texts, whose places ascend."""
    filled, begin = np.unique(text, return_index=True)
    if len(filled):
        sums[filled] += np.add.reduceat(values, begin, axis=0)


def _summed(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    every, inverse = np.unique(np.concatenate(keys), return_inverse=True)
    return every, np.bincount(inverse, np.concatenate(counts), len(every)).astype(np.int64)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of each task by language; they go on when many have gathered."""
    held: dict[str, tuple[list, list]] = {}

    def given(lang: str) -> pa.RecordBatch:
        keys, counts = _summed(*held.pop(lang))
        return pa.RecordBatch.from_arrays([pa.array([lang] * len(keys)), pa.array(keys.view(np.int64)), pa.array(counts)], ["lang", "run", "n"])

    for batch in batches:
        texts: dict[str, list[str]] = {}
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            texts.setdefault(lang, []).append(text)
        for lang, own in texts.items():
            keys, counts = held.setdefault(lang, ([], []))
            for _, some in batches_of(own):
                found = np.unique(runs(flatten(some), ORDER)[0], return_counts=True)
                keys.append(found[0])
                counts.append(found[1])
            if sum(map(len, keys)) > 2_000_000:
                one, total = _summed(keys, counts)
                held[lang] = ([one], [total])
                if len(one) > 1_000_000:
                    yield given(lang)
    for lang in list(held):
        yield given(lang)


def counted(docs: DataFrame, lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """`lang`, `run` (four characters of 16 bits) and `n`, over all texts."""
    rows = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))
    return rows.mapInArrow(_count, "lang string, run long, n long").groupBy("lang", "run").agg(F.sum("n").alias("n"))


def _kneser_ney(keys: np.ndarray, counts: np.ndarray, letters: int) -> list[tuple]:
    """For each order from 1: runs, log probabilities, contexts, log weights of the next lower order."""
    tables = [(keys, counts)]
    for _ in range(ORDER - 1):  # the number of different characters before a run
        shorter = tables[0][0] & np.uint64((1 << 16 * (ORDER - len(tables))) - 1)
        tables.insert(0, np.unique(shorter, return_counts=True))
    out, lower = [], None
    for n, (key, count) in enumerate(tables, 1):
        once, twice = int((count == 1).sum()), int((count == 2).sum())
        discount = once / (once + 2 * twice) if once and twice else 0.5
        context, which = np.unique(key >> np.uint64(16), return_inverse=True)
        total = np.bincount(which, count, len(context))
        kinds = np.bincount(which, minlength=len(context))
        weight = discount * kinds / total
        if n == 1:
            below = np.full(len(key), 1 / letters)
        else:  # every shorter run is in its table
            below = lower[1][np.searchsorted(lower[0], key & np.uint64((1 << 16 * (n - 1)) - 1))]
        lower = key, np.maximum(count - discount, 0) / total[which] + weight[which] * below
        out.append((key, np.log(lower[1]), context, np.log(weight)))
    return out


def _spread(keys: np.ndarray) -> np.ndarray:
    """A hash of each key, never the same for two."""
    mixed = (keys ^ keys >> np.uint64(31)) * np.uint64(0x9E3779B97F4A7C15)
    return mixed ^ mixed >> np.uint64(29)


class SortedHashes:
    """Sorted hashes with a row of values each; the top bits of a hash say where to look."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        hashes = _spread(keys)
        by = np.argsort(hashes)
        self.hashes, self.values = hashes[by], values[by]
        self.shift = np.uint64(64 - max(1, int(2 * len(keys)).bit_length()))
        slots = 1 << int(64 - self.shift)
        self.begin = np.searchsorted(self.hashes, np.arange(slots, dtype=np.uint64) << self.shift).astype(np.int32)

    def places(self, keys: np.ndarray) -> np.ndarray:
        """The row of each key, -1 where there is none."""
        wanted = _spread(keys)
        at = self.begin[wanted >> self.shift]
        out = np.full(len(keys), -1, np.int32)
        left = np.arange(len(keys))
        while len(left):
            inside = at < len(self.hashes)
            left, at = left[inside], at[inside]
            seen, want = self.hashes[at], wanted[left]
            hit = seen == want
            out[left[hit]] = at[hit]
            go = seen < want
            left, at = left[go], at[go] + 1
        return out


@dataclass
class Model:
    langs: list[str]
    runs: list[SortedHashes]  # by order: log probabilities, a column for each language
    contexts: list[SortedHashes]  # by order: log weights of the next lower order
    unseen: float  # log probability of a character that no language has
    sharpness: float = 1.0
    limit: float = float("inf")
    rest: SparkTables | None = None  # if the tables above have the most frequent runs only

    def log_probabilities(self, n: int, keys: np.ndarray) -> np.ndarray:
        """A row for each run of n characters."""
        if n == 0:
            return np.full((len(keys), len(self.langs)), self.unseen)
        at = self.runs[n - 1].places(keys)
        out = self.runs[n - 1].values[np.maximum(at, 0)]
        lost = np.flatnonzero(at < 0)
        if len(lost):
            before = self.contexts[n - 1].places(keys[lost] >> np.uint64(16))
            weight = np.where(before[:, None] >= 0, self.contexts[n - 1].values[np.maximum(before, 0)], 0.0)
            out[lost] = weight + self.log_probabilities(n - 1, keys[lost] & np.uint64((1 << 16 * (n - 1)) - 1))
        return out

    def cross_entropies(self, texts: list[str]) -> np.ndarray:
        """Nats per character of each text in each language."""
        out = np.zeros((len(texts), len(self.langs)))
        for start, some in batches_of(texts):
            sums, count = np.zeros((len(some), len(self.langs))), np.zeros(len(some), np.int64)
            for n, keys, text in runs_of(some):
                _add(sums, text, self.log_probabilities(n, keys))
                count += np.bincount(text, minlength=len(some))
            out[start : start + len(some)] = -sums / np.maximum(count, 1)[:, None]
        return out

    def choose(self, cost: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The best language's number, its share, and its cross-entropy, from those of all languages."""
        best = cost.argmin(axis=1)
        least = cost[np.arange(len(cost)), best]
        share = 1 / np.exp(-self.sharpness * np.minimum(cost - least[:, None], 700 / self.sharpness)).sum(axis=1)
        return best, share, least


def build(counts: dict[str, tuple[np.ndarray, np.ndarray]]) -> Model:
    """The model of some languages from their counted runs."""
    langs = sorted(counts)
    letters = len(np.unique(np.concatenate([k & np.uint64(0xFFFF) for k, _ in counts.values()]))) + 1
    parts = [_kneser_ney(*counts[lang], letters) for lang in langs]
    model = Model(langs, [], [], -np.log(letters))
    for n in range(1, ORDER + 1):
        contexts = np.unique(np.concatenate([p[n - 1][2] for p in parts]))
        weights = np.zeros((len(contexts), len(langs)))
        keys = np.unique(np.concatenate([p[n - 1][0] for p in parts]))
        rows = np.zeros((len(keys), len(langs)))
        for j, p in enumerate(parts):
            weights[np.searchsorted(contexts, p[n - 1][2]), j] = p[n - 1][3]
        model.contexts.append(SortedHashes(contexts, weights))
        lower = model.log_probabilities(n - 1, keys & np.uint64((1 << 16 * (n - 1)) - 1))
        for j, p in enumerate(parts):  # a language without the run backs off
            rows[:, j] = weights[np.searchsorted(contexts, keys >> np.uint64(16)), j] + lower[:, j]
            rows[np.searchsorted(keys, p[n - 1][0]), j] = p[n - 1][1]
        model.runs.append(SortedHashes(keys, rows))
    return model


class SparkTables:
    """The model's tables as DataFrames, for any number of runs.

    `runs[n - 1]` has `run`, `often` and `v`, an array of log probabilities by language; `contexts[n - 1]` has
    `context` and `w`, the log weights of the next lower order.
    """

    def __init__(self, found: DataFrame, langs: list[str]):
        spark, self.langs = found.sparkSession, langs
        tables = [found]
        for n in range(ORDER - 1, 0, -1):  # the number of different characters before a run
            tables.insert(0, cut(tables[0].groupBy("lang", _suffix(n).alias("run")).agg(F.count("*").alias("n")), "counts"))
        self.unseen = -math.log(tables[0].select("run").distinct().count() + 1)
        self.runs, self.contexts, lower = [], [], None
        for n, table in enumerate(tables, 1):
            discounts = []
            for r in table.groupBy("lang").agg(F.count_if(F.col("n") == 1).alias("once"), F.count_if(F.col("n") == 2).alias("twice")).collect():
                discounts.append((r.lang, r.once / (r.once + 2 * r.twice) if r.once and r.twice else 0.5))
            rows = table.join(F.broadcast(spark.createDataFrame(discounts, "lang string, discount double")), "lang")  # a row for each language
            rows = rows.withColumns({"context": F.shiftrightunsigned("run", 16), "short": _suffix(n - 1)})
            weights = rows.groupBy("lang", "context").agg(F.sum("n").alias("total"), (F.first("discount") * F.count("*") / F.sum("n")).alias("weight"))
            weights = cut(weights, "weights")
            rows = rows.join(weights, ["lang", "context"])
            # every shorter run is in its table
            rows = rows.withColumn("below", F.lit(math.exp(self.unseen))) if lower is None else rows.join(lower, ["lang", "short"])
            share = F.greatest(F.col("n") - F.col("discount"), F.lit(0.0)) / F.col("total") + F.col("weight") * F.col("below")
            rows = cut(rows.select("lang", "run", "n", share.alias("p")), "shares")
            lower = rows.select("lang", F.col("run").alias("short"), F.col("p").alias("below"))
            self.contexts.append(cut(weights.groupBy("context").agg(self._by_lang(F.log("weight")).alias("w")), "contexts"))
            own = rows.groupBy("run").agg(F.sum("n").alias("often"), self._by_lang(F.log("p")).alias("own"))
            # a language without the run backs off
            v = F.transform("lower", lambda x, i: F.coalesce(F.get("own", i), x))
            self.runs.append(cut(self._lower(own, n, self.runs[-1] if self.runs else None).select("run", "often", v.alias("v")), "runs"))

    def _by_lang(self, value: Column) -> Column:
        return F.array(*[F.max(F.when(F.col("lang") == lang, value)) for lang in self.langs])

    def _lower(self, wanted: DataFrame, n: int, shorter: DataFrame | None) -> DataFrame:
        """`wanted` with `lower`: the log probabilities of its `run` by language if no language has it."""
        rows = wanted.withColumns({"context": F.shiftrightunsigned("run", 16), "short": _suffix(n - 1)}).join(self.contexts[n - 1], "context", "left")
        if shorter is None:
            rows = rows.withColumn("below", F.array(*[F.lit(self.unseen)] * len(self.langs)))
        else:
            rows = rows.join(shorter.select(F.col("run").alias("short"), F.col("v").alias("below")), "short")
        return rows.withColumn("lower", F.transform("below", lambda x, i: x + F.coalesce(F.get("w", i), F.lit(0.0))))

    def frequent(self, n: int) -> SortedHashes:
        """The most frequent runs of n characters: up to `STORED` numbers."""
        table, most = self.runs[n - 1], STORED // len(self.langs)
        kept, least = 0, None
        for r in table.groupBy("often").agg(F.count("*").alias("runs")).orderBy(F.desc("often")).toLocalIterator():
            kept += r.runs
            if kept > most:
                break
            least = r.often
        rows = table.where(F.lit(False) if least is None else F.col("often") >= least).select("run", "v").toArrow().combine_chunks()
        values = np.array(rows.column("v").to_pylist(), float).reshape(rows.num_rows, len(self.langs))
        return SortedHashes(rows.column("run").to_numpy().view(np.uint64), values)

    def values(self, wanted: DataFrame) -> DataFrame:
        """`order`, `run` and `v` of the distinct `order` and `run` in `wanted`, by the tables or by backing off."""
        asked, lost, longer = {}, {}, None
        for n in range(ORDER, 0, -1):
            own = wanted.where(F.col("order") == n).select("run")
            asked[n] = cut((own if longer is None else own.unionByName(longer)).distinct(), "asked")
            lost[n] = cut(asked[n].join(self.runs[n - 1], "run", "left_anti"), "lost")
            longer = lost[n].select(_suffix(n - 1).alias("run"))
        out, found = None, None
        for n in range(1, ORDER + 1):
            known = asked[n].join(self.runs[n - 1], "run").select("run", "v")
            found = cut(known.unionByName(self._lower(lost[n], n, found).select("run", F.col("lower").alias("v"))), "values")
            part = found.select(F.lit(n).alias("order"), "run", "v")
            out = part if out is None else out.unionByName(part)
        return out


def _suffix(n: int) -> Column:
    """The last n characters of `run`."""
    return F.col("run").bitwiseAND(F.lit((1 << 16 * n) - 1))


def _tag(text: Column) -> Column:
    return F.unhex(F.md5(text.cast("binary")))


def _joined_costs(texts: DataFrame, model: Model) -> DataFrame:
    """`tag` of each distinct text with a letter in `texts` and its `cost`: the cross-entropies by language.

    Frequent runs are added up where the text is; one row for each other run of a text meets the tables.
    Copies of a text share a tag and add to its sums and to their count alike.
    """
    frequent = texts.sparkSession.sparkContext.broadcast(replace(model, rest=None))  # bounded by `STORED`

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = frequent.value
        for batch in batches:
            pairs = [(tag, t) for tag, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()) if has_letter(t)]
            for start, some in batches_of([t for _, t in pairs]):
                tags = pa.array([tag for tag, _ in pairs[start : start + len(some)]], pa.binary())
                sums, count = np.zeros((len(some), len(model.langs))), np.zeros(len(some), np.int64)
                for n, keys, text in runs_of(some):
                    at = model.runs[n - 1].places(keys)
                    _add(sums, text[at >= 0], model.runs[n - 1].values[at[at >= 0]])
                    count += np.bincount(text, minlength=len(some))
                    other, times = np.unique(np.stack([text[at < 0].astype(np.uint64), keys[at < 0]]), axis=1, return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [tags.take(pa.array(other[0].astype(np.int64))), pa.array([n] * len(times), pa.int32()), pa.array(other[1].view(np.int64)), pa.array(times.astype(np.int64)), pa.nulls(len(times), pa.list_(pa.float64()))], names
                    )
                zero = pa.array([0] * len(some), pa.int32())
                yield pa.RecordBatch.from_arrays([tags, zero, zero.cast(pa.int64()), pa.array(count), pa.array(sums.tolist(), pa.list_(pa.float64()))], names)

    names = ["tag", "order", "run", "times", "sums"]  # order 0: the number of all runs of the text, and the sums of the frequent ones
    rows = cut(texts.select(_tag(F.col("text")).alias("tag"), "text").mapInArrow(look_up, "tag binary, order int, run long, times long, sums array<double>"), "looked-up")
    whole = rows.where(F.col("order") == 0).select("tag", F.col("times").alias("count"), "sums")
    rare = rows.where(F.col("order") > 0)
    joined = rare.select("tag", "order", "run", "times").join(model.rest.values(rare.select("order", "run")), ["order", "run"])
    added = joined.select("tag", F.lit(0).cast("long").alias("count"), F.transform("v", lambda x: x * F.col("times")).alias("sums"))
    both = whole.unionByName(added).groupBy("tag").agg(F.sum("count").alias("count"), *[F.sum(F.get("sums", F.lit(i))).alias(f"s{i}") for i in range(len(model.langs))])
    return both.select("tag", F.array(*[-F.col(f"s{i}") / F.greatest("count", F.lit(1)) for i in range(len(model.langs))]).alias("cost"))


def train(docs: DataFrame, may_learn: Column | None = None, lang_col: str = "lang", text_col: str = "text", calibrate_on: DataFrame | None = None) -> Model | None:
    """Learns from the rows where `may_learn` holds; None if there are none with a letter.

    Sharpness and limit are calibrated on all these rows, or on the `lang` and `text` of `calibrate_on`. The
    driver gets tables of at most `STORED` runs.
    """
    known = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    known = known if may_learn is None else known.where(may_learn)
    found = cut(counted(known, lang_col, text_col), "runs")
    sizes = {r.lang: r.n for r in found.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return None
    model = _whole(found, sorted(sizes)) if sum(sizes.values()) <= STORED else _in_spark(found, sorted(sizes))
    if calibrate_on is None:
        calibrate_on = known.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))
    _calibrate(model, calibrate_on)
    return model


def calibration_rows(known: DataFrame, id_col: str = "doc_id", lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """A bounded sample for `calibrate_on`: `lang` and `text` of at most `CALIBRATION` rows, one for an id, those whose ids have the smallest hashes."""
    hashes = {"by_id": F.xxhash64(F.col(id_col).cast("string")), "by_text": F.xxhash64(F.col(text_col))}
    some = known.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"), *[h.alias(name) for name, h in hashes.items()])
    picked = some.groupBy("by_id").agg(F.min("by_text").alias("by_text")).orderBy("by_id").limit(CALIBRATION)
    copies = some.join(F.broadcast(picked), ["by_id", "by_text"])  # at most CALIBRATION rows
    return copies.groupBy("by_id", "by_text").agg(F.min(F.struct("lang", "text")).alias("row")).select("row.lang", "row.text")


def _whole(found: DataFrame, langs: list[str]) -> Model:
    rows = found.toArrow()
    lang_of = np.array(rows.column("lang").to_pylist(), object)
    run, n = rows.column("run").to_numpy().view(np.uint64), rows.column("n").to_numpy()
    counts = {}
    for lang in langs:
        own = lang_of == lang
        by = np.argsort(run[own])
        counts[lang] = run[own][by], n[own][by]
    return build(counts)


def _in_spark(found: DataFrame, langs: list[str]) -> Model:
    tables = SparkTables(found, langs)
    return Model(langs, [tables.frequent(n) for n in range(1, ORDER + 1)], [], tables.unseen, rest=tables)


def _calibrate(model: Model, texts: DataFrame) -> None:
    if model.rest:
        tagged = texts.select("lang", _tag(F.col("text").cast("string")).alias("tag"))
        costs = _joined_costs(texts.select(F.col("text").cast("string").alias("text")), model)
        _fit_scale(model, cut(tagged.join(costs, "tag").select("lang", "cost"), "costs"))
        return
    packed = texts.sparkSession.sparkContext.broadcast(model)

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = [(lang, t) for lang, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()) if has_letter(t)]
            found = packed.value.cross_entropies([t for _, t in pairs])
            yield pa.RecordBatch.from_arrays([pa.array([lang for lang, _ in pairs], pa.string()), pa.array(found.tolist(), pa.list_(pa.float64()))], ["lang", "cost"])

    _fit_scale(model, cut(texts.select("lang", "text").mapInArrow(look_up, "lang string, cost array<double>"), "costs"))


def _fit_scale(model: Model, costs: DataFrame) -> None:
    """`sharpness` and `limit` from the costs of all texts of known languages."""
    rows = costs.where(F.col("lang").isin(model.langs)).select("cost", F.get("cost", F.array_position(F.lit(model.langs), F.col("lang")).cast("int") - 1).alias("true"))
    gaps = rows.select(F.transform("cost", lambda c: c - F.array_min("cost")).alias("gaps"), (F.col("true") - F.array_min("cost")).alias("gap"))
    losses = [F.avg(F.log(F.aggregate("gaps", F.lit(0.0), lambda sum, g: sum + F.exp(g * -s))) + F.col("gap") * s) for s in SHARPNESS]
    found = gaps.agg(F.count("*"), *losses).first()
    if not found[0]:
        return
    model.sharpness = min(zip(found[1:], SHARPNESS))[1]
    model.limit = quantile(rows.select("true"), REJECT)


def quantile(values: DataFrame, share: float) -> float:
    """The exact quantile of the one column of `values`, which has numbers only, between neighbours in proportion.

    Each pass counts the values in bins of a range and goes on with the bin of the wanted rank, so neither a
    task nor the driver holds more than `BINS` of them.
    """
    x = F.col(values.columns[0])
    n, low, high = values.agg(F.count("*"), F.min(x), F.max(x)).first()
    place = share * (n - 1)
    rank, below = math.floor(place), 0
    while low < high:
        inside = values.where(x.between(low, high))
        bin_of = F.least(F.floor((x - low) / (high - low) * BINS), F.lit(BINS - 1))
        for r in inside.groupBy(bin_of.alias("bin")).agg(F.count("*").alias("n"), F.min(x).alias("low"), F.max(x).alias("high")).orderBy("bin").collect():
            if rank < below + r.n:
                low, high = r.low, r.high
                break
            below += r.n
    # the next value is the same if there are more of it
    upto, above = values.agg(F.count_if(x <= low), F.min(F.when(x > low, x))).first()
    after = low if upto > rank + 1 or above is None else above
    return low + (after - low) * (place - rank)


def identify(docs: DataFrame, model: Model | None, text_col: str = "text") -> DataFrame:
    """`docs` with `lang_pred`, `score` (0 to 1) and `rejected`."""
    names = ("lang_pred", "score", "rejected")
    others = [c for c in docs.columns if c not in names]
    rows = docs.select(*others)
    schema = docs.select(*others).schema.add("lang_pred", "string").add("score", "double").add("rejected", "boolean")
    at, joined = others.index(text_col), model is not None and model.rest is not None
    if joined:
        text = F.col(text_col).cast("string")
        costs = _joined_costs(rows.select(text.alias("text")), model).withColumnsRenamed({"tag": "tag_", "cost": "cost_"})
        rows = rows.withColumn("wanted_", _tag(text)).join(costs, F.col("wanted_") == F.col("tag_"), "left").select(*others, "cost_")
    packed = docs.sparkSession.sparkContext.broadcast(replace(model, rest=None) if joined else model)  # bounded by `STORED`

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = packed.value
        for batch in batches:
            texts = batch.column(at).to_pylist()
            given = batch.column(len(others)).to_pylist() if joined else []
            found = [k for k, t in enumerate(texts) if model is not None and has_letter(t)]
            lang, score, out = ["und"] * len(texts), [0.0] * len(texts), [True] * len(texts)
            if found:
                cost = np.array([given[k] for k in found]) if joined else model.cross_entropies([texts[k] for k in found])
                for k, b, s, c in zip(found, *(x.tolist() for x in model.choose(cost))):
                    lang[k], score[k], out[k] = model.langs[b], s, c > model.limit
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(others)], pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(out, pa.bool_())], [*others, *names])

    return rows.mapInArrow(predict, schema)
