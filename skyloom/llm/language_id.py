"""Language of every word of a text by a linear-chain conditional random field.

Features of a word are its character n-grams with the word's bounds (those at a
bound are its affixes) and the word itself (lexicon), hashed into one weight
table.  Transition weights between the languages of neighbouring words are
learned with them, on sequences that switch language.  Forward-backward gives
each word's marginals; the language of a document has the largest sum.

The model is fitted on a bounded sample of labelled documents; prediction reads
every word of every text.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyloom.llm.common import mixed, slices, text_of

#: Bytes that may stand in a word: lower-case letters and all bytes of non-ASCII characters.
LETTERS = bytes(b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
GRAMS = (2, 3, 4)
TABLE_BITS = 18
UNDETERMINED = "und"


def words_buffer(text: str) -> bytes:
    """Lower-cased words, each followed by a space, with one space in front."""
    words = text.lower().encode("utf-8", "replace").translate(LETTERS).split()
    return b" " + b" ".join(words) + b" " if words else b""


def grams(buffer: bytes) -> tuple[int, list[tuple[np.ndarray, np.ndarray]]]:
    """Number of words, and per kind of feature its table places and their words, in order of words.

    ``buffer`` holds words between single spaces, from the first byte to the last.
    """
    data = np.frombuffer(buffer, dtype=np.uint8)
    space = data == 32
    word = np.cumsum(space, dtype=np.int32) - 1  # of a gram that starts here
    n_words = int(word[-1])
    mask = np.uint64((1 << TABLE_BITS) - 1)
    wide = data.astype(np.uint64)
    parts = []
    for n in GRAMS:
        count = max(0, len(data) - n + 1)
        key = np.full(count, np.uint64(n))
        good = np.ones(count, dtype=bool)
        for k in range(n):
            key = (key << np.uint64(8)) | wide[k : k + count]
            if 0 < k < n - 1:
                good &= ~space[k : k + count]
        key = mixed(key[good])
        owner = word[:count][good]
        parts.append(((key & mask).astype(np.int32), owner))
        if n == GRAMS[0]:  # the pairs of a word and their places tell the word
            starts = np.flatnonzero(np.diff(owner, prepend=-1))
            place = (np.arange(len(owner)) - starts[owner]).astype(np.uint64)
            lexicon = np.add.reduceat(mixed(key ^ (place << np.uint64(40))), starts)
            whole = (mixed(lexicon ^ np.uint64(0xA5A5)) & mask).astype(np.int32)
    return n_words, [*parts, (whole, np.arange(n_words, dtype=np.int32))]


def features(buffer: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Table places of all features, ordered by word, and the first place of each word."""
    _, parts = grams(buffer)
    owner = np.concatenate([o for _, o in parts])
    order = np.argsort(owner, kind="stable")
    return np.concatenate([p for p, _ in parts])[order], np.flatnonzero(np.diff(owner[order], prepend=-1))


class Chain:
    """Weights of the field, and inference over many sequences at once."""

    def __init__(self, weights: np.ndarray, transitions: np.ndarray):
        self.weights, self.transitions = weights, transitions
        self.columns = [np.ascontiguousarray(column) for column in weights.T]

    def emissions(self, places: np.ndarray, starts: np.ndarray) -> np.ndarray:
        return np.add.reduceat(self.weights[places], starts, axis=0)

    def scores(self, buffer: bytes) -> np.ndarray:
        """Sums of the weights of all features, per word and language."""
        n_words, parts = grams(buffer)
        total = np.zeros((n_words, self.weights.shape[1]), dtype=np.float32)
        for places, owner in parts:
            if len(places):
                starts = np.flatnonzero(np.diff(owner, prepend=-1))
                for label in range(total.shape[1]):
                    total[owner[starts], label] += np.add.reduceat(self.columns[label][places], starts)
        return total

    def marginals(self, scores: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Forward-backward over sequences that lie one after the other in ``scores``.

        All sequences take their step t together; the longer ones come first,
        so the running ones are always a prefix.
        """
        order = np.argsort(-lengths, kind="stable")
        length = lengths[order]
        begin = (np.cumsum(lengths) - lengths)[order]
        local = np.exp(scores - scores.max(axis=1, keepdims=True)) + 1e-12
        move = np.exp(self.transitions - self.transitions.max())
        running = np.searchsorted(-length, -np.arange(int(length[0]) if len(length) else 0), side="left")
        ahead = np.empty_like(local)
        back = np.empty_like(local)
        state = None
        for t, m in enumerate(running):
            at = begin[:m] + t
            state = local[at] if t == 0 else (state[:m] @ move) * local[at]
            state = state / state.sum(axis=1, keepdims=True)
            ahead[at] = state
        labels = local.shape[1]
        state = np.full((len(length), labels), 1.0 / labels)
        for t in range(len(running) - 1, -1, -1):
            m = running[t]
            at = begin[:m] + t
            if t + 1 < len(running) and running[t + 1]:
                k = running[t + 1]
                state[:k] = (state[:k] * local[begin[:k] + t + 1]) @ move.T
                state[:k] /= state[:k].sum(axis=1, keepdims=True)
            back[at] = state[:m]
        both = ahead * back
        return both / both.sum(axis=1, keepdims=True)

    def pairs(self, scores: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Marginals and expected transitions of equally long sequences, for the gradient."""
        local, t = np.exp(scores - scores.max(axis=2, keepdims=True)) + 1e-12, scores.shape[1]
        move = np.exp(self.transitions - self.transitions.max())
        fore, rear = np.empty_like(local), np.ones_like(local)
        fore[:, 0] = local[:, 0] / local[:, 0].sum(axis=1, keepdims=True)
        for i in range(1, t):
            fore[:, i] = (fore[:, i - 1] @ move) * local[:, i]
            fore[:, i] /= fore[:, i].sum(axis=1, keepdims=True)
        for i in range(t - 2, -1, -1):
            rear[:, i] = (rear[:, i + 1] * local[:, i + 1]) @ move.T
            rear[:, i] /= rear[:, i].sum(axis=1, keepdims=True)
        one = fore * rear
        one /= one.sum(axis=2, keepdims=True)
        two = np.zeros_like(move)
        for i in range(1, t):
            joint = fore[:, i - 1, :, None] * move[None] * (local[:, i] * rear[:, i])[:, None, :]
            two += (joint / joint.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
        return one, two


def fit(texts: list[str], labels: list[int], n_labels: int, steps: int = 300, width: int = 32, batch: int = 64) -> Chain:
    """Stochastic gradient on the conditional likelihood of sequences of ``width``
    words, each joined from stretches of one to three documents."""
    rng = np.random.default_rng(7)
    by_label: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
    for text, label in zip(texts, labels):
        buffer = words_buffer(text)
        if buffer:
            places, starts = features(buffer)
            by_label.setdefault(label, []).append((places, np.append(starts, len(places))))
    kinds = sorted(by_label)
    chain = Chain(np.zeros((1 << TABLE_BITS, n_labels), np.float32), np.zeros((n_labels, n_labels)))
    if len(kinds) < 2:
        if kinds:
            chain.weights[:, kinds[0]] = 1
        return chain
    history = np.full_like(chain.weights, 1e-3)
    history_move = np.full((n_labels, n_labels), 1e-3)
    for _ in range(steps):
        parts, truth, counts = [], np.empty((batch, width), np.int64), []
        for row in range(batch):
            cuts = sorted(rng.integers(0, width + 1, rng.integers(0, 3)).tolist())
            for a, b in zip([0, *cuts], [*cuts, width]):
                at = a
                label = kinds[rng.integers(len(kinds))]
                while at < b:  # short documents follow each other
                    places, starts = by_label[label][rng.integers(len(by_label[label]))]
                    first = rng.integers(0, len(starts) - 1)
                    take = min(b - at, len(starts) - 1 - first)
                    parts.append(places[starts[first] : starts[first + take]])
                    counts.append(np.diff(starts[first : first + take + 1]))
                    truth[row, at : at + take] = label
                    at += take
        places, count = np.concatenate(parts), np.concatenate(counts)
        starts = np.cumsum(count) - count
        scores = chain.emissions(places, starts).astype(float).reshape(batch, width, n_labels)
        one, two = chain.pairs(scores)
        want = np.eye(n_labels)[truth]
        slope = ((want - one) / batch).reshape(-1, n_labels).astype(np.float32)
        used, place = np.unique(places, return_inverse=True)
        each = np.repeat(slope, count, axis=0)
        grad = np.stack([np.bincount(place, each[:, k], len(used)) for k in range(n_labels)], axis=1).astype(np.float32)
        history[used] += grad**2
        chain.weights[used] += 0.1 * grad / np.sqrt(history[used])
        seen = np.zeros((n_labels, n_labels))
        np.add.at(seen, (truth[:, :-1].ravel(), truth[:, 1:].ravel()), 1.0)
        step = (seen - two) / batch
        history_move += step**2
        chain.transitions += 0.1 * step / np.sqrt(history_move)
    return chain


def remainder(id_col: Column) -> Column:
    return F.pmod(F.crc32(id_col.cast("string").cast("binary")), F.lit(3))


def sample(docs: DataFrame, per_language: int, id_col: str, text_col: str, lang_col: str) -> list:
    """At most ``per_language`` labelled documents of each language, those with
    the smallest hash of their id; languages are counted first, so that few texts are sorted."""
    key, lang = F.col(f"`{id_col}`"), F.col(f"`{lang_col}`")
    usable = lang.isNotNull() & ~F.coalesce(remainder(key) == 1, F.lit(False))
    counts = docs.where(usable).groupBy(lang.alias("lang")).agg(F.count("*").alias("n")).collect()
    order = F.xxhash64(key)
    share = F.lit(0.0)
    for c in counts:  # somewhat more than wanted, the same for every size of the table
        share = F.when(lang == c.lang, F.lit(min(1.0, 1.5 * per_language / c.n))).otherwise(share)
    drawn = docs.where(usable & (order.cast("double") / 2.0**64 + 0.5 <= share))
    drawn = drawn.select(lang.alias("lang"), order.alias("order"), text_of(f"`{text_col}`").alias("text"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("order"))
    texts = drawn.withColumn("rank", rank).where(F.col("rank") <= per_language).drop("rank")
    return sorted(texts.collect(), key=lambda r: (r.lang, r.order, r.text))


def predictor(
    docs: DataFrame, per_language: int, id_col: str, text_col: str, lang_col: str, runs: bool = False
) -> Callable[[Column], Column]:
    """Fit the field on ``docs``; a function from a text column to (lang_pred, score, runs if asked)."""
    found = sample(docs, per_language, id_col, text_col, lang_col)
    languages = sorted({r.lang for r in found})
    number = {lang: i for i, lang in enumerate(languages)}
    chain = fit([r.text for r in found], [number[r.lang] for r in found], max(1, len(languages)))
    sent = docs.sparkSession.sparkContext.broadcast((chain.weights, chain.transitions))
    ascii_letter = re.compile("[A-Za-z]")

    def has_letter(text: str | None) -> bool:
        return bool(text) and (bool(ascii_letter.search(text)) or any(map(str.isalpha, text)))

    def stretches(best: np.ndarray) -> list[dict]:
        cuts = np.concatenate([[0], np.flatnonzero(np.diff(best)) + 1, [len(best)]])
        return [{"lang": languages[best[a]], "first": int(a), "end": int(b)} for a, b in zip(cuts[:-1], cuts[1:])]

    def label(field: Chain, texts: pd.Series) -> pd.DataFrame:
        n = len(texts)
        pred, score = [UNDETERMINED] * n, np.zeros(n)
        spans: list = [[] for _ in range(n)]
        buffers = [words_buffer(t) if languages and has_letter(t) else b"" for t in texts]
        use = [i for i in range(n) if buffers[i]]
        if use:
            lengths = np.array([buffers[i].count(b" ") - 1 for i in use])
            joined = b"".join(buffers[i][:-1] for i in use) + b" "
            probability = field.marginals(field.scores(joined), lengths)
            first = np.cumsum(lengths) - lengths
            mass = np.add.reduceat(probability, first, axis=0) / lengths[:, None]
            best = mass.argmax(axis=1)
            for k, i in enumerate(use):
                pred[i], score[i] = languages[best[k]], min(1.0, float(mass[k, best[k]]))
                if runs:
                    spans[i] = stretches(probability[first[k] : first[k] + lengths[k]].argmax(axis=1))
        return pd.DataFrame({"lang_pred": pred, "score": score} | ({"runs": spans} if runs else {}))

    shape = "lang_pred string, score double" + (", runs array<struct<lang:string,first:long,end:long>>" if runs else "")

    @F.pandas_udf(shape)
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        field = Chain(*sent.value)
        for texts in batches:
            parts = [label(field, rows["text"]) for rows in slices([pd.DataFrame({"text": texts})], "text", 1_000_000)]
            yield pd.concat(parts, ignore_index=True) if parts else label(field, texts)

    return predict


def identify(
    docs: DataFrame,
    per_language: int = 250,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    runs: bool = False,
) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score (and ``runs``: array
    of language, first word, end word exclusive).

    The model learns from at most ``per_language`` documents of each language
    whose id's CRC-32 modulo 3 is not 1.  ``score`` is the mean marginal of the
    predicted language over the words of the text.  A text that is null or has
    no letter is ``und`` with score 0, as is everything if no document has a
    label.  Ties go to the language first in code point order.  Repeated rows
    repeat their result; an empty table gives no rows; other columns are not read.
    """
    predict = predictor(docs, per_language, id_col, text_col, lang_col, runs)
    key = F.col(f"`{id_col}`")
    rows = docs.select(
        key.alias("doc_id"), F.coalesce(remainder(key) == 1, F.lit(False)).alias("held_out"),
        predict(text_of(f"`{text_col}`")).alias("p"),
    )
    return rows.select("doc_id", "held_out", "p.*")


def label_languages(
    docs: DataFrame, per_language: int = 250, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang"
) -> DataFrame:
    """``docs`` with the predicted language in ``lang_col``, without the rows whose language is ``und``.

    All columns are kept.  Texts that are null, empty or without letters go, as
    does everything if no document has a label; repeated rows stay, an empty
    table gives no rows, and null ids are never learned from.
    """
    predict = predictor(docs, per_language, id_col, text_col, lang_col)
    found = F.struct(F.struct("*").alias("_row"), predict(text_of(f"`{text_col}`"))["lang_pred"].alias("_lang"))
    # the output of a generator is not copied into the filter, so each text is labelled once
    named = docs.select(F.inline(F.array(found)))
    kept = named.where(F.col("_lang") != UNDETERMINED)
    return kept.select(F.col("_row").withField(f"`{lang_col}`", F.col("_lang")).alias("_row")).select("_row.*")
