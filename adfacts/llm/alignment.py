"""Cross-tokenizer alignment: which ids of two tokenizers end together, counted over all texts.

A text is encoded by a byte-level vocabulary (A) and a piece vocabulary (B). Where tokens of both
end at the same byte, the two token sequences are cut into groups, and the A and the B token that
end there are linked. The count of an id pair is the number of its links in the whole corpus.

External spill counting, on Spark:

1. *Runs.* Documents are read in blocks of ``block_chars`` characters. The links of a block become
   pair-document records (B id, A id, document, times), radix-partitioned by B id and sorted by
   B id, then A id; each radix of a block is one run, compressed with zstandard and written as a
   row to the shared folder. This is the spill: texts are encoded once, and lost work is read again.
2. *Merging.* The runs of a radix are merged by a k-way heap merge that counts each pair. A radix is
   split into parts by block, each of about ``group_bytes``, so that a B id that holds a third
   of all links is counted by many tasks; ``FAN_IN`` partial results are merged at a time until
   one is left per radix. It has at most one entry per pair of ids, however large the corpus.
3. *Maxima and contributions.* The merged pairs come B id by B id, so the highest count of a B id
   is known at the end of its stretch. Every part streams its runs past the counts of its radix:
   each record adds its document's share. A run returns one row, the sums of its block's
   documents; the sums of a block over all radixes meet per block.

The work between tasks is Spark's: rows of runs are grouped by (radix, part), sums by block.
No task holds more than one group of runs and the pair counts of one radix.

Documents are told apart by block and place, never by id: repeated rows are rows of their own, and
null ids stay null. Null and empty texts, and texts whose tokens do not give back their bytes,
have zeros and empty groups. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adfacts.llm.common import Scratch, whole_text, written
from adfacts.llm.encoding import (
    WORD_BORDER,
    Memory,
    encode_all,
    json_token_bytes,
    json_tokenizer,
    piece_token_bytes,
    piece_tokenizer,
    read_vocabulary,
)

RADIXES = 32
BLOCK_CHARS = 4_000_000
GROUP_BYTES = 32 << 20
FAN_IN = 8
FRAME = 1 << 16  # pairs in a frame of a merged run

# one segment

# number of A ids, of B ids, of links; links as B id * 2^32 + A id; the groups as text
Aligned = tuple[int, int, int, bytes, str]


def align(a_ids: list[int], b_ids: list[int], a_bytes: list[bytes], b_bytes: list[bytes], text: bytes) -> Aligned | None:
    """Groups and links of one text; None where the tokens of A or B do not give back its bytes."""
    a_parts, b_parts = [a_bytes[i] for i in a_ids], [b_bytes[i] for i in b_ids]
    if b"".join(a_parts) != text or b"".join(b_parts) != text:
        return None
    groups, links = [], []
    i = j = a_end = b_end = a_from = b_from = 0
    while i < len(a_ids) or j < len(b_ids):
        if a_end <= b_end and i < len(a_ids):
            a_end += len(a_parts[i])
            i += 1
        else:
            b_end += len(b_parts[j])
            j += 1
        if a_end == b_end and i > a_from and j > b_from:
            ids = [",".join(map(str, part)) for part in (a_ids[a_from:i], b_ids[b_from:j])]
            groups.append("|".join(ids))
            links.append((b_ids[j - 1] << 32) | a_ids[i - 1])
            a_from, b_from = i, j
    return len(a_ids), len(b_ids), len(links), np.array(links, dtype="<u8").tobytes(), ";".join(groups)


class Aligner:
    """Both tokenizers of a Python worker, and the segments they have aligned."""

    known: dict[tuple[bytes, bytes], Aligner] = {}

    def __init__(self, a: bytes, b: bytes) -> None:
        self.a, self.b = json_tokenizer(a, True), piece_tokenizer(b)
        self.a_bytes, self.b_bytes = json_token_bytes(a), piece_token_bytes(b)
        self.memory = Memory(self.aligned)

    @classmethod
    def of_worker(cls, a: bytes, b: bytes) -> Aligner:
        if (a, b) not in cls.known:
            cls.known[a, b] = cls(a, b)
        return cls.known[a, b]

    def aligned(self, spaced: list[str]) -> list[Aligned | None]:
        """Per text with a blank in front, its alignment. B puts that blank itself."""
        a_ids = encode_all(self.a, spaced)
        b_ids = self.b.encode([text[1:] for text in spaced], num_threads=1)
        return [
            align(x, y, self.a_bytes, self.b_bytes, text.encode())
            for x, y, text in zip(a_ids, b_ids, spaced)
        ]

    def documents(self, texts: list[str]) -> Iterator[Aligned]:
        """Per text its alignment; empty where it has none."""
        split = [WORD_BORDER.split(" " + text) if text else [] for text in texts]
        known = self.memory.values(segment for segments in split for segment in segments)
        for text, segments in zip(texts, split):
            parts = [known[segment] for segment in segments]
            if None in parts:
                parts = [part for part in self.aligned([" " + text]) if part]
            a, b, links, codes, groups = zip(*parts) if parts else ((),) * 5
            yield sum(a), sum(b), sum(links), b"".join(codes), ";".join(groups)


# runs

PACK = zstandard.ZstdCompressor(level=1).compress
UNPACK = zstandard.ZstdDecompressor().decompress


def packed(numbers: np.ndarray, kind: str = "<i8") -> bytes:
    return PACK(numbers.astype(kind).tobytes())


def unpacked(data: bytes, kind: str = "<i8") -> np.ndarray:
    return np.frombuffer(UNPACK(data), dtype=kind).astype(np.int64)


def frame(keys: np.ndarray, counts: np.ndarray) -> tuple[bytes, bytes]:
    """Ascending keys, as differences, and their counts."""
    return packed(np.diff(keys, prepend=0)), packed(counts)


Frame = tuple[np.ndarray, np.ndarray]


def frames_of(keys: list[bytes], counts: list[bytes]) -> Iterator[Frame]:
    for some_keys, some_counts in zip(keys, counts):
        yield np.cumsum(unpacked(some_keys)), unpacked(some_counts)


def heap_merge(runs: list[Iterator[Frame]]) -> Iterator[Frame]:
    """Merges runs of ascending keys and adds up the counts of equal keys, a frame of each at a time.

    The heap holds the last key of every run's present frame. Up to the least of them all runs are
    known, so these keys are complete: they are cut off everywhere, added up and handed on.
    """
    heap: list[tuple[int, int]] = []
    present: dict[int, Frame] = {}

    def advance(number: int) -> None:
        for keys, counts in runs[number]:
            if len(keys):
                present[number] = keys, counts
                heapq.heappush(heap, (int(keys[-1]), number))
                return
        present.pop(number, None)

    for number in range(len(runs)):
        advance(number)
    while heap:
        bound, _ = heap[0]
        cut = []
        for number, (keys, counts) in present.items():
            n = int(np.searchsorted(keys, bound, side="right"))
            if n:
                cut.append((keys[:n], counts[:n]))
                present[number] = keys[n:], counts[n:]
        while heap and heap[0][0] <= bound:
            advance(heapq.heappop(heap)[1])
        keys, places = np.unique(np.concatenate([keys for keys, _ in cut]), return_inverse=True)
        sums = np.zeros(len(keys), dtype=np.int64)
        np.add.at(sums, places, np.concatenate([counts for _, counts in cut]))
        yield keys, sums


def in_frames(parts: Iterator[Frame]) -> Iterator[Frame]:
    """The same pairs, in frames of at least ``FRAME`` pairs but the last."""
    waiting: list[Frame] = []
    for part in parts:
        waiting.append(part)
        if sum(len(keys) for keys, _ in waiting) >= FRAME:
            yield tuple(np.concatenate(arrays) for arrays in zip(*waiting))
            waiting = []
    if waiting:
        yield tuple(np.concatenate(arrays) for arrays in zip(*waiting))


def highest(keys: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Whether a pair's count is the highest of its B id; the keys come B id by B id."""
    b_ids = keys >> 32
    first = np.flatnonzero(np.diff(b_ids, prepend=-1))
    maxima = np.maximum.reduceat(counts, first)
    return counts == np.repeat(maxima, np.diff(np.append(first, len(keys))))


# the jobs

SPILL = (
    "block bigint, place int, n_a bigint, n_b bigint, n_groups bigint, groups string, "
    "radix int, size bigint, keys binary, counts binary, holders binary, docs binary, times binary"
)


def block_runs(codes: list[np.ndarray]) -> Iterator[tuple]:
    """Per radix: radix, size, keys, counts, documents per key, documents and times per record."""
    every = np.concatenate(codes)
    if not len(every):
        return
    places = np.repeat(np.arange(len(codes)), [len(part) for part in codes])
    keys, numbers = np.unique(every, return_inverse=True)
    records, times = np.unique(numbers * len(codes) + places, return_counts=True)
    owner, docs = records // len(codes), records % len(codes)
    radixes = (keys >> 32) % RADIXES
    for radix in np.unique(radixes):
        mine = np.flatnonzero(radixes == radix)
        of_mine = radixes[owner] == radix
        holders = np.bincount(owner[of_mine], minlength=len(keys))[mine]
        counts = np.bincount(owner[of_mine], times[of_mine], len(keys))[mine].astype(np.int64)
        row = (
            *frame(keys[mine], counts), packed(holders, "<u4"),
            packed(docs[of_mine], "<u4"), packed(times[of_mine], "<u4"),
        )
        yield int(radix), sum(map(len, row)), *row


def spilled(docs: DataFrame, doc_id: str, text: str, a: bytes, b: bytes, block_chars: int) -> DataFrame:
    """Rows of ``SPILL`` with the document id: one per document, and one per block and radix."""

    def spill(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        aligner = Aligner.of_worker(a, b)
        block = TaskContext.get().partitionId() << 32
        for batch in batches:
            for part in _blocks(batch, block_chars):
                rows, codes = [], []
                for place, (n_a, n_b, n, links, groups) in enumerate(aligner.documents(part["text"].tolist())):
                    digest = hashlib.sha256(groups.encode()).hexdigest() if n else ""
                    rows.append((block, place, n_a, n_b, n, digest, *[None] * 7))
                    codes.append(np.frombuffer(links, dtype="<i8"))
                found = pd.DataFrame(rows, columns=columns, dtype=object)
                found.insert(0, "doc", part["doc"].to_numpy())
                yield found
                runs = [(block, *[None] * 5, *run) for run in block_runs(codes)]
                if runs:
                    found = pd.DataFrame(runs, columns=columns, dtype=object)
                    found.insert(0, "doc", None)
                    yield found
                block += 1

    columns = [part.split()[0] for part in SPILL.split(", ")]
    # ids travel as text: no digit is lost where some are null
    rows = docs.select(F.col(doc_id).cast("string").alias("doc"), whole_text(text).alias("text"))
    return rows.mapInPandas(spill, f"doc string, {SPILL}")


def _blocks(batch: pd.DataFrame, block_chars: int) -> Iterator[pd.DataFrame]:
    number = batch["text"].str.len().cumsum() // block_chars
    for _, part in batch.groupby(number, sort=False):
        yield part


MERGED = "radix int, part int, size bigint, keys array<binary>, counts array<binary>"


def merged(runs: DataFrame) -> DataFrame:
    """One row of ``MERGED`` per radix and part, from rows of the same columns."""

    def merge(group: pd.DataFrame) -> pd.DataFrame:
        parts = [frames_of(keys, counts) for keys, counts in zip(group["keys"], group["counts"])]
        frames = [frame(*pairs) for pairs in in_frames(heap_merge(parts))]
        keys, counts = [list(one) for one in zip(*frames)]
        size = sum(map(len, keys)) + sum(map(len, counts))
        first = group.iloc[0]
        row = (first["radix"], first["part"], size, keys, counts)
        return pd.DataFrame([row], columns=["radix", "part", "size", "keys", "counts"])

    columns = runs.select("radix", "part", "keys", "counts")
    return columns.groupBy("radix", "part").applyInPandas(merge, MERGED)


SUMS = "block bigint, n_best binary, count_sum binary"


def contributions(runs: DataFrame, totals: DataFrame) -> DataFrame:
    """Per run the sums of its block's documents; ``totals`` holds each radix once per part."""

    def contribute(runs: pd.DataFrame, totals: pd.DataFrame) -> pd.DataFrame:
        rows = []
        for _, total in totals.iterrows():
            keys, counts = (np.concatenate(x) for x in zip(*frames_of(total["keys"], total["counts"])))
            best = highest(keys, counts)
            for run in runs.itertuples():
                found = np.searchsorted(keys, np.cumsum(unpacked(run.keys)))
                found = np.repeat(found, unpacked(run.holders, "<u4"))
                docs, times = unpacked(run.docs, "<u4"), unpacked(run.times, "<u4")
                sums = np.zeros((2, int(docs.max()) + 1), dtype=np.int64)
                np.add.at(sums[0], docs, times * best[found])
                np.add.at(sums[1], docs, times * counts[found])
                rows.append((run.block, packed(sums[0]), packed(sums[1])))
        return pd.DataFrame(rows, columns=["block", "n_best", "count_sum"])

    needed = runs.select("radix", "part", "block", "keys", "holders", "docs", "times")
    both = needed.groupBy("radix", "part").cogroup(totals.groupBy("radix", "part"))
    return both.applyInPandas(contribute, SUMS)


def sums_of_documents(shares: DataFrame) -> DataFrame:
    """block, place, n_best and count_sum: the shares of a block, one per radix, added up."""

    def add(group: pd.DataFrame) -> pd.DataFrame:
        each = [[unpacked(data) for data in group[name]] for name in ("n_best", "count_sum")]
        sums = np.zeros((2, max(map(len, each[0]))), dtype=np.int64)
        for total, shares in zip(sums, each):
            for share in shares:
                total[: len(share)] += share
        block = np.full(sums.shape[1], group["block"].iloc[0])
        columns = {"block": block, "place": np.arange(sums.shape[1]), "n_best": sums[0], "count_sum": sums[1]}
        return pd.DataFrame(columns)

    schema = "block bigint, place int, n_best bigint, count_sum bigint"
    return shares.groupBy("block").applyInPandas(add, schema)


def aligned(
    docs: DataFrame,
    a_path: str,
    b_path: str,
    doc_id: str = "doc_id",
    text: str = "text",
    block_chars: int = BLOCK_CHARS,
    group_bytes: int = GROUP_BYTES,
) -> DataFrame:
    """Per row of ``docs``: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    ``a_path`` is a byte-level vocabulary of the tokenizers library, ``b_path`` a sentencepiece
    model that puts a blank in front. Only rows of the result are kept, as a table of its own.
    """
    kind = docs.schema[doc_id].dataType
    with Scratch(docs.sparkSession) as scratch:
        vocabularies = read_vocabulary(a_path), read_vocabulary(b_path)
        spill = scratch.table(spilled(docs, doc_id, text, *vocabularies, block_chars), "alignment-spill")
        runs = spill.where(F.col("radix").isNotNull())
        # at most RADIXES rows, whatever the data
        sizes = {r["radix"]: r["size"] for r in runs.groupBy("radix").agg(F.sum("size").alias("size")).collect()}
        parts = {radix: -(-size // group_bytes) for radix, size in sizes.items()}
        per_radix = F.array(*[F.lit(parts.get(radix, 1)) for radix in range(RADIXES)])
        own_parts = F.element_at(per_radix, F.col("radix") + 1)
        runs = runs.withColumn("part", F.pmod(F.xxhash64("block"), own_parts).cast("int"))
        totals = merged(runs.select("radix", "part", F.array("keys").alias("keys"), F.array("counts").alias("counts")))
        left = max(parts.values(), default=1)
        while left > 1:
            totals = scratch.table(totals, "alignment-merged")
            totals = merged(totals.withColumn("part", F.floor(F.col("part") / FAN_IN).cast("int")))
            left = -(-left // FAN_IN)
        totals = scratch.table(totals, "alignment-totals")
        copies = totals.select(
            "radix", F.explode(F.sequence(F.lit(0), own_parts - 1)).alias("part"), "keys", "counts"
        )
        sums = sums_of_documents(contributions(runs, copies))
        rows = spill.where(F.col("radix").isNull()).select(
            F.col("doc").cast(kind).alias("doc_id"), "block", "place", "n_a", "n_b", "n_groups", "groups"
        )
        zero = F.lit(0).cast("bigint")
        result = rows.join(sums, ["block", "place"], "left").select(
            "doc_id",
            "n_a",
            "n_b",
            "n_groups",
            F.col("n_groups").alias("n_links"),
            F.coalesce("n_best", zero).alias("n_best"),
            F.coalesce("count_sum", zero).alias("count_sum"),
            F.col("groups").alias("groups_sha256"),
        )
        return written(result, "alignment")
