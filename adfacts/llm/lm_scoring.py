"""Bigram language model with deleted interpolation, trained on and applied to whole tables.

    P(w | h) = l0 / (V+1)  +  l1 * c(w) / N  +  l2 * c(h w) / c(h)

The three maximum-likelihood estimates (uniform, unigram, bigram) are mixed with weights that
depend on how often the context h was seen (``bucket``: the binary logarithm of c(h)). The
weights are learned by expectation-maximisation: a tenth of the training documents
(``deleted``) is left out, estimates are counted on the rest, and the weights make the left-out
tokens most likely. The final estimates count all training documents.

Tokens: words of the lower-cased (A-Z) text, then one end. The context of the first word is a start.

How it runs on Spark. Documents are dealt into blocks of some ``block_chars`` characters by a
hash. A block lists its distinct n-grams as sorted 64-bit hashes with their training counts,
and sends them, split by hash into buckets, to where equal n-grams of all blocks meet. There
they are summed, and each block gets the totals back in the order it asked. Scoring then reads
the documents by block again, next to their totals. No table of n-grams is ever held in one
place, frequent n-grams are combined before the shuffle, and what is exchanged grows with the
text, not with its square. Hashes of 64 bits stand for n-grams: two would have to share one to disturb a count.

For EM every left-out token is counted into a cell: its bucket and the (rounded) logarithms of
c(w)/N and c(h w)/c(h). The table of cells is bounded whatever the corpus, and covers all left-out tokens.

Defined results: a null text is empty: one end token. Without training documents N and V are
0 and every token has probability 1 by both models. Repeated rows are counted and scored once
each. A null id counts as held out. Other columns are not returned.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adfacts.llm.common import fold_share, whole_text, written

END, START = b"\n", b"\t"  # no word holds either
MIX = np.uint64(0x9E3779B97F4A7C15)
SMOOTHING = 0.1
STEPS_PER_OCTAVE = 4  # resolution of the cells for EM
NEVER = -1  # cell of an estimate that is zero
HELD_OUT, DELETED, LEARNED = 0, 1, 2


def tokens_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").lower().split() + [END]


def _mixed(values: np.ndarray) -> np.ndarray:
    """Scramble 64 bits so that nearby or related values spread."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


class Block:
    """The n-grams of some documents: distinct keys, and where each token finds its own."""

    def __init__(self, texts: list[str | None]) -> None:
        ids: dict[bytes, int] = {START: 0}
        words, contexts, self.sizes = [], [], []
        for text in texts:
            numbers = np.array([ids.setdefault(t, len(ids)) for t in tokens_of(text)])
            words.append(numbers)
            contexts.append(np.append(0, numbers[:-1]))
            self.sizes.append(len(numbers))
        word, context = np.concatenate(words), np.concatenate(contexts)
        del words, contexts
        hashes = np.array([xxhash.xxh64_intdigest(t, 7) for t in ids], dtype=np.uint64)
        pairs, pair_of = np.unique(context * len(ids) + word, return_inverse=True)
        with np.errstate(over="ignore"):
            pair_keys = _mixed(hashes[pairs // len(ids)] * MIX + hashes[pairs % len(ids)])
        # The last bit tells words (0) from pairs and the start (1).
        one = np.uint64(1)
        keys = np.concatenate([hashes & ~one, pair_keys | one])
        keys[0] |= one
        self.keys, place = np.unique(keys, return_inverse=True)
        self.word, self.context = place[word], place[context]
        self.pair = place[len(ids) + pair_of]
        self.owner = np.repeat(np.arange(len(self.sizes)), self.sizes)

    def counts(self, learned: np.ndarray) -> np.ndarray:
        """Occurrences of each key in the documents marked as learned from.

        A start counts once per document, so that it has a frequency as a context.
        """
        use = learned[self.owner]
        first = np.cumsum([0, *self.sizes[:-1]]) if self.sizes else np.array([], dtype=int)
        total = np.zeros(len(self.keys), dtype=np.int64)
        for at in (self.word[use], self.pair[use], self.context[first][learned]):
            total += np.bincount(at, minlength=len(self.keys))
        return total


def _packed(keys: np.ndarray) -> bytes:
    """Rising keys as differences, byte plane by byte plane: the high planes are all zero."""
    steps = np.diff(keys, prepend=np.uint64(0)).astype("<u8")
    return steps.view(np.uint8).reshape(-1, 8).T.tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    steps = np.ascontiguousarray(np.frombuffer(data, dtype=np.uint8).reshape(8, -1).T)
    return np.cumsum(steps.view("<u8").ravel(), dtype=np.uint64)


def _small(counts: np.ndarray) -> bytes:
    """Counts as 8-byte numbers, plane by plane, compressed: most of them are below ten."""
    return zlib.compress(counts.astype("<i8").view(np.uint8).reshape(-1, 8).T.tobytes(), 1)


def _counts(data: bytes) -> np.ndarray:
    flat = np.frombuffer(zlib.decompress(data), dtype=np.uint8)
    planes = np.ascontiguousarray(flat.reshape(8, -1).T)
    return planes.view("<i8").ravel()


def _edges(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Where each of the equal ranges of hash values starts among the sorted keys."""
    bounds = [(b * 2**64) // buckets for b in range(buckets)]
    return np.append(np.searchsorted(keys, np.array(bounds, dtype=np.uint64)), len(keys))


def _asked(buckets: int):
    def ask(pdf: pd.DataFrame) -> pd.DataFrame:
        block = Block(list(pdf["text"]))
        learned = (pdf["part"] != HELD_OUT).to_numpy()
        counts, edges = block.counts(learned), _edges(block.keys, buckets)
        name, part, tokens = pdf["block"].iloc[0], pdf["part"].iloc[0], sum(block.sizes)
        rows = []
        for b, (i, j) in enumerate(zip(edges, edges[1:])):
            if i < j:
                said = 0 if rows else tokens  # once per block
                rows.append((name, part, b, said, _packed(block.keys[i:j]), _small(counts[i:j])))
        return pd.DataFrame(rows, columns=["block", "part", "bucket", "tokens", "keys", "counts"])

    return ask


def _answered(pdf: pd.DataFrame) -> pd.DataFrame:
    """Sum what all blocks have of one range of keys; answer each in its own order."""
    keys = [_unpacked(k) for k in pdf["keys"]]
    counts = [_counts(c) for c in pdf["counts"]]
    distinct, place = np.unique(np.concatenate(keys), return_inverse=True)
    flat = np.concatenate(counts)
    deleted = np.repeat((pdf["part"] == DELETED).to_numpy(), [len(k) for k in keys])
    total = np.bincount(place, weights=flat, minlength=len(distinct)).astype(np.int64)
    rest = np.bincount(place, weights=flat * ~deleted, minlength=len(distinct)).astype(np.int64)
    words = int(((distinct & np.uint64(1) == 0) & (total > 0)).sum())
    edges = np.cumsum([0, *map(len, keys)])
    out = pdf[["block", "part", "bucket", "tokens"]].copy()
    out["words"] = [words] + [0] * (len(pdf) - 1)  # once per bucket
    spans = list(zip(edges, edges[1:]))
    out["total"] = [_small(total[place[i:j]]) for i, j in spans]
    out["rest"] = [
        _small(rest[place[i:j]]) if part == DELETED else None
        for part, (i, j) in zip(pdf["part"], spans)
    ]
    return out


def _gathered(answers: pd.DataFrame, column: str) -> np.ndarray:
    ordered = answers.sort_values("bucket")[column]
    return np.concatenate([_counts(x) for x in ordered]) if len(ordered) else np.array([], dtype=np.int64)


def _bucket(context: np.ndarray) -> np.ndarray:
    """0 for an unseen context, else one more than the binary logarithm of its frequency."""
    return np.where(context > 0, np.frexp(context.astype(float))[1], 0)


def _totals(answers: DataFrame) -> tuple[int, int, int]:
    """Training tokens, those of the documents not left out, and distinct training words."""
    row = answers.agg(
        F.sum(F.when(F.col("part") != HELD_OUT, F.col("tokens"))),
        F.sum(F.when(F.col("part") == LEARNED, F.col("tokens"))),
        F.sum("words"),
    ).first()
    return row[0] or 0, row[1] or 0, row[2] or 0


def _cells(learned_tokens: int):
    def cells(docs: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        columns = ["bucket", "unigram", "bigram", "n"]
        if docs.empty:
            return pd.DataFrame(columns=columns)
        block, c = Block(list(docs["text"])), _gathered(answers, "rest")
        word, pair, context = c[block.word], c[block.pair], c[block.context]

        def octaves(share: np.ndarray) -> np.ndarray:
            with np.errstate(divide="ignore"):
                steps = np.round(-np.log2(share) * STEPS_PER_OCTAVE)
            return np.where(share > 0, steps, NEVER).astype(int)

        table = pd.DataFrame(
            {
                "bucket": _bucket(context),
                "unigram": octaves(word / max(learned_tokens, 1)),
                "bigram": octaves(pair / np.maximum(context, 1)),
            }
        )
        return table.value_counts().rename("n").reset_index()[columns]

    return cells


def learn_weights(cells: pd.DataFrame, vocabulary: int, rounds: int = 60) -> np.ndarray:
    """Weights of the three estimates per bucket (rows) by expectation-maximisation.

    Buckets without tokens, and as many pseudo-tokens in every bucket, follow the mean weights.
    """
    weights = np.tile([0.2, 0.5, 0.3], (66, 1))
    weights[0] = [0.3, 0.7, 0.0]
    if cells.empty:
        return weights
    bucket = cells["bucket"].to_numpy(int)
    n = cells["n"].to_numpy(float)

    def share(column: str) -> np.ndarray:
        steps = cells[column].to_numpy(float)
        return np.where(steps == NEVER, 0.0, 2.0 ** (-steps / STEPS_PER_OCTAVE))

    estimates = np.column_stack([np.full(len(cells), 1 / (vocabulary + 1)), share("unigram"), share("bigram")])
    for _ in range(rounds):
        parts = weights[bucket] * estimates
        parts *= (n / parts.sum(axis=1))[:, None]
        mean = parts.sum(axis=0) / n.sum()
        for b in range(len(weights)):
            sums = parts[bucket == b].sum(axis=0) + 5 * mean
            weights[b] = np.maximum(sums / sums.sum(), 1e-9)
        weights[0, 2] = 0.0  # an unseen context says nothing
        weights /= weights.sum(axis=1, keepdims=True)
    return weights


def _scores(weights: np.ndarray, tokens: int, vocabulary: int):
    def score(docs: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        columns = ["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"]
        if docs.empty:
            return pd.DataFrame(columns=columns)
        block, c = Block(list(docs["text"])), _gathered(answers, "total")
        word, pair, context = c[block.word], c[block.pair], c[block.context]
        base = np.log10((word + SMOOTHING) / (tokens + SMOOTHING * (vocabulary + 1)))
        mix = weights[_bucket(context)]
        p = (
            mix[:, 0] / (vocabulary + 1)
            + mix[:, 1] * word / max(tokens, 1)
            + mix[:, 2] * pair / np.maximum(context, 1)
        )
        if tokens == 0:
            p = np.ones(len(word))

        def per_text(values: np.ndarray) -> np.ndarray:
            return np.bincount(block.owner, weights=values, minlength=len(docs))

        return pd.DataFrame(
            {
                "doc_id": docs["doc_id"].to_numpy(),
                "held_out": (docs["part"] == HELD_OUT).to_numpy(),
                "n_tokens": block.sizes,
                "n_known": per_text(word > 0).astype(np.int64),
                "base_score": per_text(base),
                "score": per_text(np.log10(np.minimum(p, 1.0))),
            }
        )[columns]

    return score


def language_model_scores(docs: DataFrame, block_chars: int = 8_000_000) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Blocks hold documents of one part (held out, deleted, learned) and are about
    ``block_chars`` characters large; a task needs some 20 times that in memory.
    """
    fold = fold_share("doc_id", 10)
    rows = docs.select(
        F.col("doc_id").cast("string").alias("doc_id"),  # pandas would turn nulls into NaN
        whole_text().alias("text"),
        F.when(fold == 0, HELD_OUT).when(fold == 1, DELETED).otherwise(LEARNED).alias("part"),
    )
    size = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, -(-size // block_chars))
    # The two small parts have a tenth of the documents each, so fewer blocks of one size. An
    # id may repeat often, so the text takes part in dealing.
    tenth = F.lit(-(-blocks // 8))
    of_part = F.when(F.col("part") == LEARNED, F.lit(blocks)).otherwise(tenth)
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), of_part))
    asked = dealt.groupBy("block", "part").applyInPandas(
        _asked(blocks), "block bigint, part int, bucket int, tokens bigint, keys binary, counts binary"
    )
    answers = written(
        asked.groupBy("bucket").applyInPandas(
            _answered,
            "block bigint, part int, bucket int, tokens bigint, words bigint, total binary, rest binary",
        ),
        "lm-answers",
    )
    tokens, rest, vocabulary = _totals(answers)
    raw = (
        dealt.where(F.col("part") == DELETED)
        .groupBy("block", "part")
        .cogroup(answers.where(F.col("part") == DELETED).groupBy("block", "part"))
        .applyInPandas(_cells(rest), "bucket int, unigram int, bigram int, n bigint")
    )
    cells = raw.groupBy("bucket", "unigram", "bigram").agg(F.sum("n").alias("n")).toPandas()
    weights = learn_weights(cells.sort_values(["bucket", "unigram", "bigram"]), vocabulary)
    scored = (
        dealt.groupBy("block", "part")
        .cogroup(answers.groupBy("block", "part"))
        .applyInPandas(
            _scores(weights, tokens, vocabulary),
            "doc_id string, held_out boolean, n_tokens bigint, n_known bigint, "
            "base_score double, score double",
        )
    )
    return scored.select(
        F.col("doc_id").cast(docs.schema["doc_id"].dataType).alias("doc_id"), "held_out", "n_tokens", "n_known",
        F.lit(tokens).cast("bigint").alias("train_tokens"), "base_score", "score",
    )
