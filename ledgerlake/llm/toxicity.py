"""Toxicity: a convolutional text classifier trained in numpy.

A word's vector is the sum of hashed embedding rows of the word and of its first 4 and
6 bytes, so inflected and compound forms share what they begin with.  Filters of
widths 1, 2 and 3 slide over the words; each keeps its maximum over the text (max
pooling, which is zero-padded, so short and empty texts have a value) and a logistic
layer on the maxima gives a logit.  Language, source, id and labels are never inputs of
a score.

Against learning rows by heart: embedding rows that fewer than ``MIN_TEXTS`` training
texts use stay zero (they are tied to padding), the first coordinate starts at the
smoothed log odds of the row's texts being toxic, words are dropped at random and
embeddings shrink after each epoch.  Calibration is cross-fitted: each row's logit comes
from a model trained without its fold, Platt scaling on these logits makes a logit a
score, and on the same scores each language gets the threshold that separates its
classes best.

Fitting learns from every labelled id (one row of each) with its whole text.  Up to
``SHARD_ROWS`` ids and ``SHARD_BYTES`` of text are one model's, cross-fitted over
``FOLDS`` folds.  More are dealt by a hash of the id into shards of about that size, and
Spark tasks train a model a shard, all from the same start; the model is their average,
where an embedding row counts by the texts that use it.  Each shard belongs to a fold, so
the average of the other folds' shards gives a row's cross-fitted logit; these meet the
driver as counts by language and logit rounded to 1 / ``LOGIT_STEPS``.  Scoring
covers every whole text.  A filter applied to a word is a row of a table, so scoring is
lookups, shifted sums and maxima.

Defined results: null, empty and wordless texts get the score of padding alone; labels
that are null do not count, a document with several labels counts as toxic if one says
so; without both classes among the labelled rows every score is the share of toxic rows
(0 without labels); of rows that share a labelled id the one whose text has the least
hash is learned from; repeated rows are scored each for itself; an empty table gives an
empty result.  A language with too few rows of a class takes the common threshold.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import byte_slices, discard, pick, shuffles_freed, staged, unused, worker_cache

SHARD_ROWS = 6000          # labelled ids one process learns from
SHARD_BYTES = 16 << 20     # and their text
MAX_BYTES = 24_000         # of a text in ``sample_rows``, if a bound is asked for
BUCKETS = 1 << 15
DIM = 16
WIDTHS = (1, 2, 3)
FILTERS = 8
EPOCHS = 5
FOLDS = 5                  # of cross-fitting
MIN_TEXTS = 3              # training texts that must use an embedding row
WORD_DROP = 0.3
SHRINK = 0.05              # of embeddings, an epoch
LANGUAGE_ROWS = 15         # of each class, for a threshold of its own
CACHED_WORDS = 100_000
CHUNK = 20_000             # words scored at a time
SLICE = 2000               # positions of training texts at a time: they fit a core's cache
LOGIT_STEPS = 1000         # of a cross-fitted logit, for each unit
PARTS = 64                 # pieces of the embeddings that are averaged apart

# A-Z to a-z; ASCII letters and all bytes from 0x80 stay; the rest separates words.
_LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def word_buckets(word: bytes) -> tuple[int, int, int]:
    h = xxhash.xxh32_intdigest
    return h(word) % BUCKETS, h(word[:4], 4) % BUCKETS, h(word[:6], 6) % BUCKETS


@dataclass
class Model:
    """Embeddings, filters (width -> [offset, dim, filter]), output layer, Platt scaling and thresholds."""
    embed: np.ndarray
    filters: list[np.ndarray]
    bias: np.ndarray
    out: np.ndarray
    out_bias: float
    platt: tuple[float, float] = (1.0, 0.0)
    constant: float | None = None
    threshold: float = 0.5
    thresholds: dict[str, float] = field(default_factory=dict)

    def table(self, words: list[bytes]) -> np.ndarray:
        """What each word adds to each filter at each offset, one row a word."""
        ids = np.array([word_buckets(w) for w in words], np.int64).reshape(-1, 3)
        return self.embed[ids].sum(1) @ np.concatenate([f[j] for f in self.filters for j in range(len(f))], axis=1)

    def score(self, logits: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(logits), self.constant)
        a, b = self.platt
        return 1 / (1 + np.exp(-np.clip(a * logits + b, -30, 30)))


def _sums(rows: np.ndarray) -> np.ndarray:
    """Filter sums at each position, from the words' rows; two positions of padding follow the last."""
    parts, at = [], 0
    n = len(rows) - max(WIDTHS) + 1
    for k in WIDTHS:
        z = rows[:n, at:at + FILTERS].copy()
        for j in range(1, k):
            z += rows[j:n + j, at + j * FILTERS:at + (j + 1) * FILTERS]
        parts.append(z)
        at += k * FILTERS
    return np.concatenate(parts, axis=1)


def _flat(ids: list[np.ndarray], pad: int, own: list[int] | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids of all texts, each followed by padding; starts of the texts; mask of positions that count.

    ``own``: how many positions of each text count; by default its words and one of padding.
    """
    gap = max(WIDTHS)
    sizes = np.array([len(x) + gap for x in ids])
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64)
    flat = np.full(int(sizes.sum()) + gap, pad, np.int64)
    counts = np.zeros(len(flat), bool)
    for i, (s, x) in enumerate(zip(starts, ids, strict=True)):
        flat[s:s + len(x)] = x
        counts[s:s + (len(x) + 1 if own is None else own[i])] = True
    return flat, starts, counts


class _Words(dict):
    """Word -> row of the model's table; row 0 is padding."""

    def __init__(self, model: Model):
        super().__init__()
        self.model, self.new = model, []
        self.rows = np.zeros((CACHED_WORDS // 8, sum(WIDTHS) * FILTERS), np.float32)
        self.used = 1

    def __missing__(self, word: bytes) -> int:
        self.new.append(word)
        n = self[word] = self.used + len(self.new) - 1
        return n

    def settle(self) -> np.ndarray:
        if self.new:
            need = self.used + len(self.new)
            if need > len(self.rows):
                self.rows = np.concatenate([self.rows, np.zeros((max(need - len(self.rows), len(self.rows)), self.rows.shape[1]), np.float32)])
            self.rows[self.used:need] = self.model.table(self.new)
            self.used, self.new = need, []
        return self.rows


def logits_of(model: Model, words: _Words, texts: list[bytes]) -> np.ndarray:
    """Logits of a slice of texts; a text longer than CHUNK words is scored in overlapping chunks and their maxima united."""
    if len(words) > CACHED_WORDS:
        words.clear()
        words.used = 1
    ids, own, owners = [], [], []
    overlap = max(WIDTHS) - 1
    for i, t in enumerate(texts):
        tokens = t.translate(_LETTERS).split()
        all_ids = np.fromiter(map(words.__getitem__, tokens), np.int64, len(tokens))
        for at in range(0, max(1, len(all_ids)), CHUNK):
            last = at + CHUNK >= len(all_ids)
            ids.append(all_ids[at:] if last else all_ids[at:at + CHUNK + overlap])
            own.append(len(ids[-1]) + 1 if last else CHUNK)       # the last chunk also has a position of padding
            owners.append(i)
    rows = words.settle()
    pooled = np.empty((len(ids), len(WIDTHS) * FILTERS), np.float32)
    at = 0
    while at < len(ids):                                          # a bounded number of positions at a time
        n = max(1, int(np.searchsorted(np.cumsum(own[at:]), 4 * CHUNK, side="right")))
        flat, starts, counts = _flat(ids[at:at + n], 0, own[at:at + n])
        z = _sums(rows[flat])
        z[~counts[:len(z)]] = -np.inf
        pooled[at:at + n] = np.maximum.reduceat(z, starts, axis=0)
        at += n
    first = np.flatnonzero(np.diff(np.array([-1, *owners])))
    best = np.maximum(np.maximum.reduceat(pooled, first, axis=0) + model.bias, 0)
    return best @ model.out + model.out_bias


def _scorer(docs: DataFrame, model: Model):
    shared, key = docs.sparkSession.sparkContext.broadcast(vars(model)), f"toxicity:{uuid.uuid4().hex}"

    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = Model(**shared.value)
        words = worker_cache(key, lambda: _Words(model))
        model = words.model
        for texts in batches:
            batch = pa.RecordBatch.from_arrays([texts], names=["text"])
            out = [model.score(logits_of(model, words, part)) for _, part in byte_slices(batch, size=1 << 19)]
            yield pa.array(np.concatenate(out) if out else [], pa.float64())
    return F.arrow_udf(score, "double")


# ---------------------------------------------------------------- fitting
def _uses(texts: list[np.ndarray], y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How many texts, and how many toxic ones, use each embedding row."""
    uses, toxic = np.zeros(BUCKETS + 1), np.zeros(BUCKETS + 1)
    for t, label in zip(texts, y, strict=True):
        own = np.unique(t)
        uses[own] += 1
        toxic[own] += label
    return uses, toxic


def _odds(uses: np.ndarray, toxic: np.ndarray, n: float, pos: float) -> np.ndarray:
    """Smoothed log odds of each embedding row's texts being toxic, of ``pos`` toxic ones among ``n``."""
    share = (pos + 1) / (n + 2)
    odds = np.log((toxic + 2 * share) / (pos + 2)) - np.log((uses - toxic + 2 * (1 - share)) / (n - pos + 2))
    return odds.astype(np.float32)


def _known(uses: np.ndarray, part: int = PARTS - 1) -> np.ndarray:
    """Whether enough texts use a row of the embeddings (or of a part of them); the last row is padding's."""
    known = uses >= MIN_TEXTS
    if part == PARTS - 1:
        known[-1] = False
    return known


def _best_positions(embed: np.ndarray, filters: list[np.ndarray], words: np.ndarray, flat: np.ndarray, starts: np.ndarray,
                    sizes: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Where each filter is largest in each text, and how large; a bounded number of positions at a time."""
    best, top = np.zeros((len(starts), len(WIDTHS) * FILTERS), np.int64), np.full((len(starts), len(WIDTHS) * FILTERS), -np.inf, np.float32)
    ends = starts + np.array(sizes) + 1
    for at in range(0, int(ends[-1]), SLICE):
        n = min(at + SLICE, int(ends[-1])) - at
        x = embed[words[flat[at:at + n + max(WIDTHS) - 1]]].sum(1)
        z = np.concatenate([sum(x[j:n + j] @ f[j] for j in range(len(f))) for f in filters], axis=1)
        for i in range(int(np.searchsorted(ends, at, "right")), int(np.searchsorted(starts, at + n))):
            lo = max(int(starts[i]), at)
            part = z[lo - at:min(int(ends[i]), at + n) - at]
            place = part.argmax(0)
            value = np.take_along_axis(part, place[None], 0)[0]
            better = value > top[i]
            best[i][better], top[i][better] = place[better] + lo, value[better]
    return best, top


def _train(texts: list[np.ndarray], y: np.ndarray, seed: int = 7) -> Model:
    """``texts``: for each text an array [words, 3] of bucket numbers.  Adagrad on the logistic loss."""
    rng = np.random.default_rng(seed)
    n_out = len(WIDTHS) * FILTERS
    uses, toxic = _uses(texts, y)
    odds, known = _odds(uses, toxic, len(y), y.sum()), _known(uses)
    embed = rng.normal(0, 0.05, (BUCKETS + 1, DIM)).astype(np.float32)
    embed[:, 0] = 0.5 * odds
    embed[~known] = 0
    filters = [rng.normal(0, (1 / (k * DIM)) ** 0.5, (k, DIM, FILTERS)).astype(np.float32) for k in WIDTHS]
    bias, out, out_bias = np.zeros(n_out, np.float32), rng.normal(0, 0.3, n_out).astype(np.float32), np.zeros(1, np.float32)
    for f, sign in zip(filters, np.sign(out).reshape(len(WIDTHS), FILTERS), strict=True):
        f[:, 0] = np.abs(f[:, 0]) * sign                 # a filter starts by looking for what its output speaks for
    params = [*filters, bias, out, out_bias]
    seen, seen_e = [np.full(p.shape, 1e-6, np.float32) for p in params], np.full(BUCKETS + 1, 1e-4, np.float32)
    weight = np.where(y == 1, 0.5 / max(1, y.sum()), 0.5 / max(1, (1 - y).sum())) * len(y)
    rate = 0.1
    for _ in range(EPOCHS):
        for batch in np.array_split(rng.permutation(len(texts)), max(1, len(texts) // 32)):
            seen_words = [texts[i][rng.random(len(texts[i])) >= WORD_DROP] for i in batch]
            words = np.concatenate([np.full((1, 3), BUCKETS, np.int64), *seen_words])
            words = np.where(known[words], words, BUCKETS)
            sizes = [len(t) for t in seen_words]
            ends = 1 + np.cumsum(sizes)
            flat, starts, _ = _flat([np.arange(e - n, e) for e, n in zip(ends, sizes, strict=True)], 0)
            best, top = _best_positions(embed, filters, words, flat, starts, sizes)
            raw = top + bias
            pooled = np.maximum(raw, 0)
            p = 1 / (1 + np.exp(-np.clip(pooled @ out + out_bias[0], -30, 30)))
            g = ((p - y[batch]) * weight[batch] / len(batch)).astype(np.float32)
            g_pool = np.outer(g, out) * (raw > 0)
            grads = [np.zeros_like(f) for f in filters] + [g_pool.sum(0), pooled.T @ g + 1e-4 * out, g.sum(keepdims=True)]
            places = np.unique(np.concatenate([(best + j).ravel() for j in range(max(WIDTHS))]))
            x, g_x = embed[words[flat[places]]].sum(1), np.zeros((len(places), DIM), np.float32)
            for w, f in enumerate(filters):
                cols = slice(w * FILTERS, (w + 1) * FILTERS)
                at, gw = best[:, cols], g_pool[:, cols]
                for j in range(len(f)):
                    here = np.searchsorted(places, at + j)
                    grads[w][j] = np.einsum("bf,bfd->df", gw, x[here])
                    np.add.at(g_x, here.ravel(), (gw[:, :, None] * f[j].T[None]).reshape(-1, DIM))
            for q, gr, s in zip(params, grads, seen, strict=True):
                s += gr * gr
                q -= rate * gr / np.sqrt(s)
            live = np.flatnonzero(np.abs(g_x).sum(1) > 0)
            live = live[flat[places[live]] > 0]
            rows, g_e = words[flat[places[live]]].ravel(), np.repeat(g_x[live], 3, axis=0)
            keys, back = np.unique(rows, return_inverse=True)
            total = np.zeros((len(keys), DIM), np.float32)
            np.add.at(total, back, g_e)
            seen_e[keys] += (total * total).mean(1)
            embed[keys] -= rate * total / np.sqrt(seen_e[keys])[:, None]
            embed[BUCKETS] = 0
        embed *= 1 - SHRINK
    return Model(embed, filters, bias, out, float(out_bias[0]))


def _platt(logits: np.ndarray, y: np.ndarray, times: np.ndarray | None = None) -> tuple[float, float]:
    """``times``: how many rows each entry stands for (one, if not given)."""
    times = np.ones(len(y)) if times is None else times
    pos, neg = (y * times).sum(), ((1 - y) * times).sum()
    target = np.where(y == 1, (pos + 1) / (pos + 2), 1 / (neg + 2))
    x = np.stack([logits, np.ones_like(logits)], 1)
    w = np.array([1.0, 0.0])
    for _ in range(50):                                  # Newton steps, slightly regularised towards (1, 0)
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (p * (1 - p) * times)[:, None]).T @ x + 1e-3 * np.eye(2)
        w -= np.clip(np.linalg.solve(h, x.T @ ((p - target) * times) + 1e-3 * (w - [1.0, 0.0])), -2, 2)
    return max(float(w[0]), 1e-3), float(w[1])


def best_threshold(scores: np.ndarray, y: np.ndarray, times: np.ndarray | None = None) -> float:
    """Middle of the best gap between the classes (share of toxic found less share of others rejected), within 0.35 to 0.9."""
    order = np.argsort(scores)
    n = (np.ones(len(y)) if times is None else times)[order]
    s, t, u = scores[order], y[order] * n, (1 - y[order]) * n
    gain = np.concatenate([[1.0], (t.sum() - np.cumsum(t)) / t.sum()]) - np.concatenate([[1.0], (u.sum() - np.cumsum(u)) / u.sum()])
    cut = int(np.argmax(gain))
    low, high = (s[cut - 1] if cut else 0.0), (s[cut] if cut < len(s) else 1.0)
    return float(np.clip((low + high) / 2, 0.35, 0.9))


_SAMPLE_DDL = "doc_id long, toxic int, lang string, ids binary"


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = [np.array([word_buckets(w) for w in (t or b"").translate(_LETTERS).split()], np.int32).tobytes()
               for t in batch.column("text").cast(pa.binary()).to_pylist()]
        yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in ("doc_id", "toxic", "lang")], pa.array(ids, pa.binary())],
                                         names=["doc_id", "toxic", "lang", "ids"])


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        label_col: str = "toxic", allowed=None) -> Model:
    """Train on all labelled documents; ``allowed`` (id column -> condition) says which rows may be learned from."""
    d = pick(docs, doc_id=id_col, text=text_col, lang=lang_col).withColumn("doc_id", F.col("doc_id").cast("long"))
    d = d.withColumn("h", F.xxhash64("text")) if allowed is None else d.where(allowed("doc_id")).withColumn("h", F.xxhash64("text"))
    firsts = d.groupBy("doc_id").agg(F.min(F.struct("h", F.octet_length("text").alias("size"))).alias("first"))
    chosen = staged(_marked(labels, id_col, label_col, allowed).join(firsts, "doc_id").select("doc_id", "toxic", "first.*"), "toxicity-chosen")
    n, size = chosen.agg(F.count(F.lit(1)), F.coalesce(F.sum("size"), F.lit(0))).first()
    if n <= SHARD_ROWS and size <= SHARD_BYTES:
        return fit_rows(sample_rows(docs, labels, id_col, text_col, lang_col, label_col, allowed).collect())
    with shuffles_freed(docs.sparkSession):
        return _fit_shards(d, chosen, max(FOLDS, -(-n // SHARD_ROWS), -(-size // SHARD_BYTES)))


def _marked(labels: DataFrame, id_col: str, label_col: str, allowed) -> DataFrame:
    """doc_id and toxic of the labelled ids that may be learned from."""
    marked = pick(labels, doc_id=id_col, toxic=label_col).where("doc_id is not null and toxic is not null")
    if allowed is not None:
        marked = marked.where(allowed("doc_id"))
    return marked.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(F.col("toxic").cast("int")).alias("toxic"))


def sample_rows(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, lang_col: str, label_col: str, allowed=None,
                per_class: int | None = None, max_bytes: int | None = None) -> DataFrame:
    """doc_id, toxic, lang and the words' bucket numbers of one row a labelled id.

    All of them, unless a bound is asked for: ``per_class`` ids of each class, texts of ``max_bytes``.
    """
    d = pick(docs, doc_id=id_col, text=text_col, lang=lang_col).withColumn("doc_id", F.col("doc_id").cast("long"))
    if max_bytes is not None:
        d = d.where(F.coalesce(F.octet_length("text"), F.lit(0)) <= max_bytes)
    picks = _marked(labels, id_col, label_col, allowed)
    if per_class is not None:
        marked = picks.join(d.select("doc_id").distinct(), "doc_id", "left_semi").withColumn("h", F.xxhash64("doc_id"))
        parts = [marked.where((F.col("toxic") != 0) == F.lit(bool(c))).orderBy("h", "doc_id").limit(per_class).drop("h") for c in (0, 1)]
        picks = parts[0].unionByName(parts[1])
    row = F.struct(F.xxhash64("text").alias("h"), "text", "lang")
    sample = d.join(picks, "doc_id").groupBy("doc_id").agg(F.max("toxic").alias("toxic"), F.min(row).alias("row"))
    return sample.select("doc_id", "toxic", "row.lang", "row.text").mapInArrow(_features, _SAMPLE_DDL)


def _buckets_of(rows: list) -> list[np.ndarray]:
    return [np.frombuffer(r["ids"], np.int32).reshape(-1, 3) for r in rows]


def _constant(share: float) -> Model:
    """The model of rows that lack a class."""
    return Model(np.zeros((BUCKETS + 1, DIM), np.float32), [np.zeros((k, DIM, FILTERS), np.float32) for k in WIDTHS],
                 np.zeros(len(WIDTHS) * FILTERS, np.float32), np.zeros(len(WIDTHS) * FILTERS, np.float32), 0.0, constant=share)


def _calibrate(model: Model, logits: np.ndarray, y: np.ndarray, langs: np.ndarray, times: np.ndarray) -> Model:
    """Platt scaling and thresholds from cross-fitted logits, each of so many rows."""
    model.platt = _platt(logits, y, times)
    scores = model.score(logits)
    model.threshold = best_threshold(scores, y, times)
    for lang in sorted(set(langs.tolist())):
        own = langs == lang
        if min((y * times)[own].sum(), ((1 - y) * times)[own].sum()) >= LANGUAGE_ROWS:
            model.thresholds[lang] = best_threshold(scores[own], y[own], times[own])
    return model


def fit_rows(rows: list) -> Model:
    """The model of the rows of one process."""
    rows = sorted(rows, key=lambda r: xxhash.xxh64_intdigest(str(r["doc_id"])))
    texts = _buckets_of(rows)
    y = np.array([r["toxic"] != 0 for r in rows], np.float64)
    if not 0 < y.sum() < len(y):
        return _constant(float(y.mean()) if len(y) else 0.0)
    logits, fold = np.zeros(len(y)), _place(y) % FOLDS
    for k in np.unique(fold):
        out = fold == k
        if out.all():                                    # one row of each class: nothing is left to train on
            break
        logits[out] = _all_logits(_train([texts[i] for i in np.flatnonzero(~out)], y[~out]), [texts[i] for i in np.flatnonzero(out)])
    return _calibrate(_train(texts, y), logits, y, np.array([r["lang"] or "" for r in rows]), np.ones(len(y)))


# ---------------------------------------------------------------- fitting over shards
# A piece of a shard's model: some embedding rows, weighted by the texts that use them, or (part -1) all else, weighted by rows.
_PIECE_DDL = "shard int, part int, uses binary, toxic binary, weight binary, v binary"
_MEAN_DDL = "chain int, part int, v binary"


def _rest(model: Model) -> np.ndarray:
    return np.concatenate([*[f.ravel() for f in model.filters], model.bias, model.out, [model.out_bias]]).astype(np.float32)


def _model_of(embed: np.ndarray, rest: np.ndarray) -> Model:
    n_out = len(WIDTHS) * FILTERS
    ends = np.cumsum([*[k * DIM * FILTERS for k in WIDTHS], n_out, n_out])
    *filters, bias, out, out_bias = np.split(rest, ends)
    return Model(embed, [f.reshape(k, DIM, FILTERS) for f, k in zip(filters, WIDTHS, strict=True)], bias, out, float(out_bias[0]))


def _train_shard(key: tuple[pa.Scalar, ...], found: pa.Table) -> pa.Table:
    """The pieces of the model of a shard's rows (doc_id, toxic, text)."""
    rows = [r for batch in _features(iter(found.select(["doc_id", "toxic", "lang", "text"]).to_batches(max_chunksize=256))) for r in batch.to_pylist()]
    rows.sort(key=lambda r: xxhash.xxh64_intdigest(str(r["doc_id"])))
    texts, y = _buckets_of(rows), np.array([r["toxic"] != 0 for r in rows], np.float64)
    uses, toxic = _uses(texts, y)
    model = _train(texts, y)
    weight = np.where(_known(uses), uses, 0)
    out: dict[str, list] = {"shard": [], "part": [], "uses": [], "toxic": [], "weight": [], "v": []}
    for part, at in enumerate(np.array_split(np.arange(BUCKETS + 1), PARTS)):
        for k, v in zip(out, (key[0].as_py(), part, *(x[at].astype(np.float64).tobytes() for x in (uses, toxic, weight)), model.embed[at].tobytes()), strict=True):
            out[k].append(v)
    counts = np.array([len(y)], np.float64)
    for k, v in zip(out, (key[0].as_py(), -1, counts.tobytes(), np.array([y.sum()]).tobytes(), counts.tobytes(), _rest(model).tobytes()), strict=True):
        out[k].append(v)
    kinds = (pa.int32(), pa.int32(), *[pa.binary()] * 4)
    return pa.table([pa.array(v, t) for v, t in zip(out.values(), kinds, strict=True)], names=list(out))


def _mean_pieces(by_fold: dict[int, tuple[float, float]]):
    """Weighted means of a piece over the shards: of all (chain -1), and of those outside each fold."""
    def mean(found: pa.Table) -> pa.Table:
        part = found.column("part")[0].as_py()
        sums: dict[int, list[np.ndarray]] = {}
        for batch in found.sort_by("shard").to_batches(max_chunksize=64):
            for r in batch.to_pylist():
                uses, toxic, weight = (np.frombuffer(r[c]) for c in ("uses", "toxic", "weight"))
                v = np.frombuffer(r["v"], np.float32).reshape(len(weight), -1) * weight[:, None]
                own = sums.setdefault(r["shard"] % FOLDS, [np.zeros_like(uses), np.zeros_like(uses), np.zeros_like(uses), np.zeros_like(v)])
                for total, x in zip(own, (uses, toxic, weight, v), strict=True):
                    total += x
        chains = []
        for chain in range(-1, FOLDS):
            kept = [f for f in sums if f != chain]
            if not kept:
                continue
            uses, toxic, weight, v = (sum(x) for x in zip(*(sums[f] for f in kept), strict=True))
            v = v / np.maximum(weight, 1)[:, None]
            if part >= 0:                                # known only over all shards: such a row stays at its start
                n, pos = (sum(by_fold[f][i] for f in by_fold if f != chain) for i in (0, 1))
                start = _known(uses, part=part) & (weight == 0)
                v[start, 0] = 0.5 * _odds(uses, toxic, n, pos)[start]
            chains.append((chain, v.astype(np.float32).tobytes()))
        return pa.table([pa.array([c for c, _ in chains], pa.int32()), pa.array([part] * len(chains), pa.int32()),
                         pa.array([v for _, v in chains], pa.binary())], names=["chain", "part", "v"])
    return mean


def _shard(shards: int) -> Column:
    return F.pmod(F.xxhash64("doc_id", F.lit("shard")), F.lit(shards)).cast("int")


def _fit_shards(d: DataFrame, chosen: DataFrame, shards: int) -> Model:
    """``d``: doc_id, text, lang, h of the rows that may be learned from; ``chosen``: the labelled ids with their row's h."""
    fold = (_shard(shards) % FOLDS).alias("fold")
    by_fold = {r["fold"]: (float(r["n"]), float(r["pos"])) for r in chosen.groupBy(fold).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("toxic") != 0).alias("pos")).collect()}
    n, pos = (sum(x) for x in zip(*by_fold.values(), strict=True))
    if not 0 < pos < n:
        return _constant(pos / n)
    rows = d.join(chosen.select("doc_id", "h", "toxic").hint("merge"), ["doc_id", "h"]).groupBy("doc_id", "h").agg(
        F.max("toxic").alias("toxic"), F.min(F.struct("lang")).alias("l"), F.first("text").alias("text"))
    rows = staged(rows.select(_shard(shards).alias("shard"), "doc_id", "toxic", "l.lang", "text"), "toxicity-rows")
    dealt = lambda: rows.repartition(2 * shards, "shard").groupBy("shard")
    pieces = staged(dealt().applyInArrow(_train_shard, _PIECE_DDL), "toxicity-pieces")
    found: dict[int, dict[int, np.ndarray]] = {}
    for r in pieces.groupBy("part").applyInArrow(_mean_pieces(by_fold), _MEAN_DDL).collect():
        found.setdefault(r["chain"], {})[r["part"]] = np.frombuffer(r["v"], np.float32)
    models = {c: _model_of(np.concatenate([v[p] for p in range(PARTS)]).reshape(-1, DIM), v[-1]) for c, v in found.items()}
    # the cross-fitted logit of every row that is learned from, by the model that has not seen its fold
    counted = dealt().applyInArrow(_shard_logits(rows, models), "lang string, step long, bad boolean") \
        .groupBy("lang", "step", "bad").count().orderBy("lang", "step", "bad").collect()
    discard(rows, pieces)
    columns = [np.array([r[c] for r in counted]) for c in ("step", "bad", "lang", "count")]
    return _calibrate(models[-1], columns[0] / LOGIT_STEPS, columns[1].astype(np.float64), columns[2], columns[3].astype(np.float64))


def _shard_logits(docs: DataFrame, models: dict[int, Model]):
    """Language, rounded logit and class of a shard's rows, by the model of its fold; without one logits are 0."""
    shared, key = docs.sparkSession.sparkContext.broadcast({c: vars(m) for c, m in models.items() if c >= 0}), f"toxicity-fold:{uuid.uuid4().hex}"

    def logits(shard: tuple[pa.Scalar, ...], found: pa.Table) -> pa.Table:
        fold, z = shard[0].as_py() % FOLDS, [np.zeros(0)]
        if fold in shared.value:
            words = worker_cache(f"{key}-{fold}", lambda: _Words(Model(**shared.value[fold])))
            for batch in found.select(["text"]).to_batches(max_chunksize=256):
                z += [logits_of(words.model, words, part) for _, part in byte_slices(batch, size=1 << 19)]
        else:
            z.append(np.zeros(len(found)))
        step = np.rint(np.concatenate(z) * LOGIT_STEPS).astype(np.int64)
        return pa.table([pc.fill_null(found.column("lang"), ""), pa.array(step), pc.not_equal(found.column("toxic"), 0)], names=["lang", "step", "bad"])
    return logits


def _place(y: np.ndarray) -> np.ndarray:
    """Position of each row among the rows of its class."""
    return np.where(y == 1, np.cumsum(y == 1), np.cumsum(y == 0)) - 1


def _all_logits(model: Model, texts: list[np.ndarray]) -> np.ndarray:
    return np.concatenate([_logits(model, texts[i:i + 64]) for i in range(0, len(texts), 64)])


def _logits(model: Model, texts: list[np.ndarray]) -> np.ndarray:
    every = np.concatenate([np.full((1, 3), BUCKETS, np.int64), *texts])
    sizes = [len(t) for t in texts]
    flat, starts, _ = _flat([np.arange(e - n, e) for e, n in zip(1 + np.cumsum(sizes), sizes, strict=True)], 0)
    _, top = _best_positions(model.embed, model.filters, every, flat, starts, sizes)
    return np.maximum(top + model.bias, 0) @ model.out + model.out_bias


# ---------------------------------------------------------------- applying
def threshold_of(model: Model, lang: Column) -> Column:
    out = F.lit(model.threshold)
    for name, t in model.thresholds.items():
        out = F.when(lang == name, F.lit(t)).otherwise(out)
    return out


def score_texts(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """One row per document: doc_id, score, threshold of its language, rejected."""
    score = _scorer(docs, model)
    d = pick(docs, doc_id=id_col, text=text_col, lang=lang_col).withColumn("threshold", threshold_of(model, F.col("lang")))
    return d.withColumn("score", score("text")).select("doc_id", "score", "threshold", (F.col("score") >= F.col("threshold")).alias("rejected"))


def drop_toxic(docs: DataFrame, model: Model, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The documents below their language's threshold, all their columns as they were."""
    score = _scorer(docs, model)
    names, flag = docs.columns, unused(docs, "_score")
    flat = docs.toDF(*[f"_c{i}" for i in range(len(names))])
    lang = F.col(f"_c{names.index(lang_col)}")
    return flat.withColumn(flag, score(f"_c{names.index(text_col)}")).where(F.col(flag) < threshold_of(model, lang)).drop(flag).toDF(*names)
