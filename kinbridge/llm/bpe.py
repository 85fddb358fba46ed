"""Byte-level BPE by recursive DuckDB queries in every task.

A rank file gives the tokens; two tokens may merge where their bytes together are a token,
at that token's rank.  Texts are split by the vocabulary's pattern.  The distinct pieces
of a batch that are not tokens themselves go to an in-process DuckDB: token positions
join the merge table, each word contracts its leftmost pair of least rank, and the query
recurses until no word has a pair left.  An ordered aggregation turns the tokens of each
piece back into bytes.  Ids and bytes of a document are those of its pieces in order.

The recursion takes one round per merge, so pieces of more than ``LONG_PIECE`` bytes are
merged by a priority queue instead, in the same order of merges.

Null texts count as empty: no ids and no bytes.  Whole texts are encoded whatever their
length.  Repeated rows give equal rows; other columns are carried along untouched.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterable, Iterator
from functools import lru_cache

import duckdb
import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LONG_PIECE = 400
#: Pieces whose ids a Python worker remembers if they take about 250 bytes each (fewer only
#: cost time); what counts are the bytes that ids, texts and table entries take.
REMEMBERED = 350_000
PIECE_BYTES, ENTRY_BYTES = 250, 220
#: Words and bytes of one DuckDB query, which so never needs to spill; a longer word would
#: be a query of its own.
WORDS_PER_QUERY = 20_000
BYTES_PER_QUERY = 1 << 20
#: Texts and characters that are split and encoded together; a longer text is taken alone.
TEXTS_AT_ONCE = 512
CHARS_AT_ONCE = 1 << 22

_START = """
SELECT wid, list(tok ORDER BY pos) AS toks, false AS done FROM positions GROUP BY wid
"""

#: One round: positions join the merges, the least (rank, place) of each word contracts.
ENCODE = f"""
WITH RECURSIVE state(wid, toks, done) AS (
  {_START}
  UNION ALL (
    WITH pairs AS (
      SELECT wid, unnest(toks[:-2]) AS a, unnest(toks[2:]) AS b,
             generate_subscripts(toks[2:], 1) AS place
      FROM state WHERE NOT done
    ), least AS (
      SELECT wid, min((CAST(rank AS BIGINT) << 24) + place) AS best
      FROM pairs JOIN merges USING (a, b) GROUP BY wid
    )
    SELECT wid,
           CASE WHEN best IS NULL THEN toks
                ELSE list_concat(
                  list_append(toks[:(best & 16777215) - 1], CAST(best >> 24 AS INTEGER)),
                  toks[(best & 16777215) + 2:]) END,
           best IS NULL
    FROM state LEFT JOIN least USING (wid) WHERE NOT done
  )
)
SELECT wid, toks FROM state WHERE done
"""

#: Hexadecimal text, as only text can be aggregated in order.
DECODE = """
WITH placed AS (
  SELECT wid, unnest(toks) AS id, generate_subscripts(toks, 1) AS place FROM encoded
)
SELECT wid, string_agg(hexed, '' ORDER BY place) AS hexed
FROM placed JOIN tokens USING (id) GROUP BY wid ORDER BY wid
"""


def read_ranks(path: str) -> bytes:
    with open(path, "rb") as file:
        return file.read()


def split_pattern(pattern: str) -> regex.Pattern:
    """The pattern with white space as Unicode has it, without the separators 1C to 1F."""
    exact = pattern.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}")
    return regex.compile(exact)


@lru_cache(maxsize=2)
def parse_ranks(blob: bytes) -> dict[bytes, int]:
    return {
        base64.b64decode(token): int(rank) for token, rank in map(bytes.split, blob.splitlines())
    }


def _groups(sizes: Iterable[int], most: int, total: int) -> Iterator[tuple[int, int]]:
    """Cuts a sequence into (start, end) of up to ``most`` things and ``total`` size."""
    start = end = held = 0
    for end, size in enumerate(sizes):
        if end > start and (end - start == most or held + size > total):
            yield start, end
            start, held = end, 0
        held += size
        end += 1
    if end > start:
        yield start, end


class Coder:
    """Encodes and decodes pieces in one task."""

    def __init__(self, blob: bytes, pattern: str):
        self.ranks = parse_ranks(blob)
        self.bytes_of = {rank: token for token, rank in self.ranks.items()}
        self.pattern = split_pattern(pattern)
        self.first = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        merges = [
            (left, right, rank)
            for token, rank in self.ranks.items()
            for cut in range(1, len(token))
            if (left := self.ranks.get(token[:cut])) is not None
            and (right := self.ranks.get(token[cut:])) is not None
        ]
        a, b, rank = np.array(merges, np.int32).reshape(-1, 3).T
        del merges
        # Without a folder DuckDB cannot spill to the worker's disk.
        self.db = duckdb.connect(
            config={"threads": 1, "memory_limit": "500MB", "temp_directory": ""}
        )
        self._table("merges", pa.table({"a": a, "b": b, "rank": rank}))
        ids = pa.array(list(self.bytes_of), pa.int32())
        self._table("tokens", pa.table({"id": ids, "hexed": [b.hex() for b in self.bytes_of.values()]}))
        #: Ids (little-endian) and decoded bytes of pieces.
        self.ids: dict[str, bytes] = {}
        self.text: dict[str, bytes] = {}
        self.held = 0

    def _keep(self, piece: str, ids: bytes, text: bytes) -> None:
        self.ids[piece], self.text[piece] = ids, text
        self.held += self._size(piece)

    def _size(self, piece: str) -> int:
        return ENTRY_BYTES + len(self.ids[piece]) + 2 * len(self.text[piece])

    def _table(self, name: str, rows: pa.Table) -> None:
        self.db.register("given", rows)
        self.db.execute(f"CREATE OR REPLACE TEMP TABLE {name} AS SELECT * FROM given")
        self.db.unregister("given")

    def _long(self, word: bytes) -> list[int]:
        """Merges in order of (rank, place) from a queue of pairs."""
        def rank_of(a: int, b: int) -> int | None:
            return self.ranks.get(self.bytes_of[a] + self.bytes_of[b])

        ids = self.first[np.frombuffer(word, np.uint8)].tolist()
        after, before = list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1))
        queue = [
            (rank, i)
            for i, (a, b) in enumerate(zip(ids, ids[1:], strict=False))
            if (rank := rank_of(a, b)) is not None
        ]
        heapq.heapify(queue)
        while queue:
            rank, i = heapq.heappop(queue)
            j = after[i] if ids[i] >= 0 else len(ids)
            if j >= len(ids) or rank_of(ids[i], ids[j]) != rank:
                continue
            ids[i], ids[j] = rank, -1
            after[i] = after[j]
            if after[j] < len(ids):
                before[after[j]] = i
            for left in (before[i], i):
                right = after[left] if left >= 0 else len(ids)
                if right < len(ids):
                    new = rank_of(ids[left], ids[right])
                    if new is not None:
                        heapq.heappush(queue, (new, left))
        return [x for x in ids if x >= 0]

    def _words(self, words: list[bytes]) -> Iterator[tuple[bytes, bytes]]:
        """Ids and decoded bytes of words that are not tokens."""
        length = np.array([len(w) for w in words])
        flat = np.frombuffer(b"".join(words), np.uint8)
        start = np.cumsum(length) - length
        self._table(
            "positions",
            pa.table(
                {
                    "wid": np.repeat(np.arange(len(words), dtype=np.int32), length),
                    "pos": (np.arange(len(flat)) - np.repeat(start, length)).astype(np.int32),
                    "tok": self.first[flat],
                }
            ),
        )
        self.db.execute(f"CREATE OR REPLACE TEMP TABLE encoded AS {ENCODE}")
        return self._decoded()

    def _decoded(self) -> Iterator[tuple[bytes, bytes]]:
        rows = self.db.sql("SELECT toks FROM encoded ORDER BY wid").to_arrow_table()
        toks = rows["toks"].combine_chunks()
        ends = (4 * toks.offsets.to_numpy()).tolist()
        ids = toks.values.to_numpy().astype("<u4").tobytes()
        texts = self.db.sql(DECODE).to_arrow_table()["hexed"].to_pylist()
        for a, b, text in zip(ends[:-1], ends[1:], texts, strict=True):
            yield ids[a:b], bytes.fromhex(text)

    def _learn(self, pieces: set[str]) -> None:
        words, places, long_words = [], [], []
        for piece in pieces:
            word = piece.encode("utf-8", "surrogatepass")
            rank = self.ranks.get(word)
            if rank is not None:
                self._keep(piece, rank.to_bytes(4, "little"), self.bytes_of[rank])
            elif len(word) <= LONG_PIECE:
                words.append(word)
                places.append(piece)
            else:
                long_words.append((piece, word))
        for at, end in _groups(map(len, words), WORDS_PER_QUERY, BYTES_PER_QUERY):
            for piece, found in zip(places[at:end], self._words(words[at:end]), strict=True):
                self._keep(piece, *found)
        for piece, word in long_words:
            toks = pa.array([self._long(word)], pa.list_(pa.int32()))
            self._table("encoded", pa.table({"wid": pa.array([0], pa.int32()), "toks": toks}))
            (found,) = self._decoded()
            self._keep(piece, *found)

    def documents(self, texts: list[str], remember: int) -> Iterator[tuple[bytes, bytes]]:
        """Ids (little-endian unsigned 32 bits) and decoded bytes of every text.

        New pieces of all texts are encoded together, so give a few texts at a time.
        """
        pieces = [self.pattern.findall(text) for text in texts]
        needed = set().union(*pieces)
        if self.held > remember * PIECE_BYTES:
            # Frequent pieces are among those of any few texts.
            self.ids = {p: x for p, x in self.ids.items() if p in needed}
            self.text = {p: self.text[p] for p in self.ids}
            self.held = sum(map(self._size, self.ids))
        self._learn(needed.difference(self.ids))
        for own in pieces:
            yield (
                b"".join(map(self.ids.__getitem__, own)),
                b"".join(map(self.text.__getitem__, own)),
            )


@lru_cache(maxsize=1)
def task_coder(blob: bytes, pattern: str) -> Coder:
    """The coder of a Python worker, which keeps what it learned for its next task."""
    return Coder(blob, pattern)


def with_tokens(
    spark: SparkSession,
    docs: DataFrame,
    path: str,
    pattern: str,
    name: str,
    ids: bool = True,
    remember: int = REMEMBERED,
) -> DataFrame:
    """The documents with a struct of n_tokens, ids_sha256, decoded_sha256 and, if asked, ids.

    The rank file is read on the driver and sent to the tasks; its size is that of the
    vocabulary.
    """
    shared = spark.sparkContext.broadcast(read_ranks(path))
    fields = "n_tokens long, ids_sha256 string, decoded_sha256 string"

    @F.pandas_udf(fields + (", ids array<int>" if ids else ""))
    def coded(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        coder = task_coder(shared.value, pattern)
        for batch in texts:
            batch = [t or "" for t in batch]
            rows = []
            # A few texts at a time, so what is held does not follow the batch.
            for at, end in _groups(map(len, batch), TEXTS_AT_ONCE, CHARS_AT_ONCE):
                for tokens, text in coder.documents(batch[at:end], remember):
                    row = [
                        len(tokens) // 4,
                        hashlib.sha256(tokens).hexdigest(),
                        hashlib.sha256(text).hexdigest(),
                    ]
                    rows.append([*row, np.frombuffer(tokens, "<i4")] if ids else row)
            columns = ["n_tokens", "ids_sha256", "decoded_sha256", "ids"][: 4 if ids else 3]
            yield pd.DataFrame(rows, columns=columns)

    return docs.withColumn(name, coded(F.col("text")))
