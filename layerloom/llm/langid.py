"""Language identification with a small convolutional network over bytes."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerloom.llm.rows import wrapped

WIDTHS = (2, 3, 4)
FILTERS = 12  # per width
EMBEDDING = 8
WINDOW = 128  # bytes that the network sees at a time
STEP = WINDOW - max(WIDTHS) + 1  # windows overlap so that no run of bytes is cut

#: Bounds of the labelled sample: documents of a language, and windows of a document.
DOCS_PER_LANGUAGE = 256
WINDOWS_PER_DOC = 8
#: Training steps, at least and for each language.
STEPS, STEPS_PER_LANGUAGE = 250, 25

UNDECIDED = "und"
_LETTER = regex.compile(r"\p{L}")
#: The same in Spark, whose older character tables leave letters of young scripts unassigned.
_LETTERS = r"\p{L}\p{Cn}"
_BATCH_WINDOWS = 1024
#: Characters of the sample's texts in all, shared out evenly, and of one text at most and at least.
_SAMPLE_CHARS, _MOST_CHARS, _LEAST_CHARS = 1 << 26, 1 << 16, WINDOW * WINDOWS_PER_DOC


@dataclass(frozen=True)
class Network:
    """Trained weights: byte embeddings, filters of each width, and the softmax layer."""

    languages: tuple[str, ...]
    embedding: np.ndarray  # 256 x EMBEDDING
    filters: np.ndarray  # max width x EMBEDDING x all filters; 0 beyond a filter's width
    bias: np.ndarray
    weights: np.ndarray  # all filters x languages
    offset: np.ndarray

    def byte_pairs(self) -> list[np.ndarray]:
        """What each pair of bytes adds to all filters at offsets 0 and 2."""
        by_byte = [self.embedding @ f for f in self.filters]
        return [
            (by_byte[j][:, None, :] + by_byte[j + 1][None, :, :]).reshape(1 << 16, -1).astype(np.float32)
            for j in (0, 2)
        ]


def _prepared(text: str) -> bytes:
    return text.lower().encode("utf-8", "replace")


def windows_of(data: bytes) -> np.ndarray:
    """All windows of a text, the last one filled up with zeros."""
    n = max(1, math.ceil((len(data) - (WINDOW - STEP)) / STEP))
    padded = np.zeros((n - 1) * STEP + WINDOW, np.uint8)
    padded[: len(data)] = np.frombuffer(data, np.uint8)
    return np.lib.stride_tricks.sliding_window_view(padded, WINDOW)[::STEP]


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def _pooled(windows: np.ndarray, pairs: list[np.ndarray]) -> np.ndarray:
    """Largest value of every filter over each window, before bias."""
    w = windows.astype(np.uint16)
    pair = (w[:, :-1] << np.uint16(8)) | w[:, 1:]
    values = pairs[0].take(pair[:, :STEP], axis=0)
    values += pairs[1].take(pair[:, 2 : STEP + 2], axis=0)
    return values.max(axis=1)


def probabilities(network: Network, windows: np.ndarray, pairs: list[np.ndarray]) -> np.ndarray:
    parts = []
    for i in range(0, len(windows), _BATCH_WINDOWS):
        hidden = np.maximum(_pooled(windows[i : i + _BATCH_WINDOWS], pairs) + network.bias, 0)
        parts.append(_softmax(hidden @ network.weights + network.offset))
    return np.concatenate(parts)


def train(
    texts: list[tuple[str, str]], *, steps: int | None = None, batch: int = 128, seed: int = 7
) -> Network | None:
    """Fit the network with Adam on (language, text) pairs; None without any.

    Half of the windows are cut to a random length, so that short texts are learnt too.
    Steps grow with the number of languages, so that each is seen as often among many.
    """
    texts = sorted(t for t in texts if _LETTER.search(t[1]))
    languages = tuple(sorted({lang for lang, _ in texts}))
    if not languages:
        return None
    steps = max(STEPS, STEPS_PER_LANGUAGE * len(languages)) if steps is None else steps
    number = {lang: k for k, lang in enumerate(languages)}
    rng = np.random.default_rng(seed)
    samples, labels = [], []
    for lang, text in texts:
        found = windows_of(_prepared(text))
        if len(found) > WINDOWS_PER_DOC:
            found = found[np.sort(rng.choice(len(found), WINDOWS_PER_DOC, replace=False))]
        samples.append(found)
        labels += [number[lang]] * len(found)
    x, y = np.concatenate(samples), np.array(labels)
    of_language = [np.flatnonzero(y == k) for k in range(len(languages))]

    deepest, total = max(WIDTHS), FILTERS * len(WIDTHS)
    used = np.zeros((deepest, 1, total), np.float32)
    for k, width in enumerate(WIDTHS):
        used[:width, :, k * FILTERS : (k + 1) * FILTERS] = 1
    p = {
        "e": rng.normal(0, 0.5, (256, EMBEDDING)),
        "f": rng.normal(0, 0.5, (deepest, EMBEDDING, total)) * used,
        "b": np.zeros(total),
        "w": rng.normal(0, 0.2, (total, len(languages))),
        "o": np.zeros(len(languages)),
    }
    p["e"][0] = 0  # the filling
    first, second = ({k: np.zeros_like(v) for k, v in p.items()} for _ in range(2))
    for step in range(1, steps + 1):
        # Every language is seen equally often, whatever its share of the rows.
        chosen = [rng.choice(of_language[k]) for k in rng.integers(len(languages), size=batch)]
        window, target = x[chosen].copy(), y[chosen]
        for row in range(0, batch, 2):
            window[row, rng.integers(8, WINDOW) :] = 0
        by_byte = [p["e"] @ f for f in p["f"]]
        values = sum(by_byte[j][window[:, j : j + STEP]] for j in range(deepest))
        best = values.argmax(axis=1)
        pooled = np.take_along_axis(values, best[:, None, :], 1)[:, 0, :] + p["b"]
        hidden = np.maximum(pooled, 0)
        error = _softmax(hidden @ p["w"] + p["o"])
        error[np.arange(batch), target] -= 1
        error /= batch
        back = (error @ p["w"].T) * (pooled > 0)
        g = {"o": error.sum(0), "w": hidden.T @ error, "b": back.sum(0), "e": np.zeros_like(p["e"])}
        g["f"] = np.zeros_like(p["f"])
        rows = np.arange(batch)[:, None]
        for j in range(deepest):
            byte = window[rows, best + j]  # batch x filters
            seen = p["e"][byte]
            g["f"][j] = np.einsum("bf,bfe->ef", back, seen)
            np.add.at(g["e"], byte, back[:, :, None] * p["f"][j].T[None])
        g["f"] *= used
        g["e"][0] = 0
        for k in p:
            first[k] += 0.1 * (g[k] - first[k])
            second[k] += 0.001 * (g[k] ** 2 - second[k])
            p[k] -= 0.01 * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    weights = {k: v.astype(np.float32) for k, v in p.items()}
    return Network(languages, weights["e"], weights["f"], weights["b"], weights["w"], weights["o"])


def labelled_sample(docs: DataFrame, id_col: str, text_col: str, lang_col: str) -> list[tuple[str, str]]:
    """(language, text) of about ``DOCS_PER_LANGUAGE`` documents of each language.

    Every language that has a text with a letter is in the sample. Documents are
    taken by a hash of their id and text, at the rate that their language asks
    for, and the one with the smallest hash always; equal ones are taken once.
    """
    letter = F.col(text_col).rlike(f"[{_LETTERS}]")
    scale = 1 << 30
    share = F.pmod(F.xxhash64(F.col(id_col).cast("string"), text_col), F.lit(scale))
    labelled = docs.filter(F.col(lang_col).isNotNull() & letter).select(
        F.col(lang_col).alias("lang"), F.col(text_col).alias("text"), share.alias("share")
    )
    counts = labelled.groupBy("lang").agg(F.approx_count_distinct("share").alias("n"), F.min("share").alias("first")).collect()
    if not counts:
        return []
    # A quarter more than wanted; the surplus is cut below.
    wanted = math.ceil(1.25 * DOCS_PER_LANGUAGE)
    below = [max(r["first"] + 1, min(scale, math.ceil(wanted / r.n * scale))) for r in counts]
    rates = F.map_from_arrays(F.lit([r.lang for r in counts]), F.lit(below).cast("array<bigint>"))
    # Windows are drawn at random from the text, of which so much is read, from the first letter if need be.
    most = min(_MOST_CHARS, max(_LEAST_CHARS, _SAMPLE_CHARS // (wanted * len(counts))))
    at = F.greatest(F.length("text") - most, F.lit(0))
    piece = F.substring("text", F.pmod("share", at + 1).cast("int") + 1, F.lit(most))
    lettered = F.substring("text", F.length(F.regexp_extract("text", f"^[^{_LETTERS}]*+", 0)) + 1, F.lit(most))
    taken = labelled.filter(F.col("share") < F.element_at(rates, F.col("lang")))
    drawn = taken.select("lang", "share", F.when(piece.rlike(f"[{_LETTERS}]"), piece).otherwise(lettered).alias("text"))
    once = drawn.groupBy("lang", "share").agg(F.min("text").alias("text"))
    out, n = [], {}
    for lang, _, text in sorted((r.lang, r.share, r.text) for r in once.collect()):
        n[lang] = n.get(lang, 0) + 1
        if n[lang] <= DOCS_PER_LANGUAGE:
            out.append((lang, text))
    return out


def _predictor(network: Network | None):
    """Language and score of each text, as columns of a struct."""

    def kernel(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        pairs = network.byte_pairs() if network else None
        for texts in batches:
            languages: list[str] = [UNDECIDED] * len(texts)
            scores = [0.0] * len(texts)
            pending: list[tuple[int, np.ndarray]] = []
            size = 0
            for i, text in enumerate(texts):
                text = text.as_py()
                if network and text is not None and _LETTER.search(text):
                    pending.append((i, windows_of(_prepared(text))))
                    size += len(pending[-1][1])
                if pending and (size >= _BATCH_WINDOWS or i + 1 == len(texts)):
                    found = probabilities(network, np.concatenate([w for _, w in pending]), pairs)
                    begins = np.cumsum([0] + [len(w) for _, w in pending[:-1]])
                    means = np.add.reduceat(found, begins, axis=0)
                    for (k, w), total in zip(pending, means):
                        best = int(total.argmax())
                        languages[k] = network.languages[best]
                        scores[k] = min(1.0, float(total[best]) / len(w))
                    pending, size = [], 0
            yield pa.StructArray.from_arrays(
                [pa.array(languages, pa.string()), pa.array(scores, pa.float64())], names=["lang_pred", "score"]
            )

    # Like a nondeterministic function it runs once for a row, before any filter on its result.
    return F.arrow_udf(kernel, "lang_pred string, score double").asNondeterministic()


def learnt_from(id_col: str) -> Column:
    """Whether a document may be learnt from: its id's checksum modulo 4 is not 2."""
    checksum = F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    return F.pmod(checksum, F.lit(4)) != 2


def predict(
    docs: DataFrame,
    learn: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    *,
    with_text: bool = False,
) -> DataFrame:
    """doc (a struct of the columns), lang_pred and score of every document.

    The network is trained on a sample of ``learn``, bounded for each language, and
    tells apart all its languages that have a text with a letter. Every window of the
    whole text is scored; the language with the largest mean probability wins,
    and that mean is the score.

    - A NULL text or one without a letter is ``und`` with score 0; so is every
      text if nothing can be learnt (no labelled rows).
    - Rows with a NULL language are predicted, but not learnt from.
    - Repeated rows and ids are predicted one by one; an empty table gives an empty result.
    - ``doc`` leaves the text out unless ``with_text`` is set.
    """
    network = train(labelled_sample(learn, id_col, text_col, lang_col))
    columns = [c for c in docs.columns if with_text or c != text_col]
    rows = wrapped(docs, id_col, text_col).select(
        F.struct(*[F.col(f"doc.`{c}`").alias(c) for c in columns]).alias("doc"), "text"
    )
    found = rows.select("doc", _predictor(network)("text").alias("found"))
    return found.select("doc", "found.lang_pred", "found.score")
