"""Byte-level BPE encoding of a whole corpus (problem 8).

Each partition cuts its texts into words by the tokenizer's published pattern,
and words further at byte pairs that occur inside no token of the vocabulary:
no merge can ever cross such a place, so the cut changes no result.  The
distinct pieces of a batch become token-position rows of an in-process DuckDB,
where a recursive query joins neighbouring tokens with the merge table and
contracts each piece's leftmost pair of minimum rank until nothing merges; an
ordered aggregation reads the ids off.  Nothing is shuffled.
"""

from __future__ import annotations

import heapq
import json
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

#: Words of a byte-level BPE, as published with the tokenizer (fixed value).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

DEFAULT_VOCABULARY = os.environ.get("MILLRACE_TOKENIZERS", "/opt/tokenizers") + "/byte_bpe_50k.json"

#: Pieces longer than this go to the heap: the recursive query takes as many
#: rounds as a piece has merges, each over all its positions, so its work on a
#: piece grows with the square of its length.  (On the test documents no piece is as long.)
LONGEST_PIECE = 1024
#: Sum of the squares of the lengths of the pieces one query gets: what bounds its memory.
SQUARES = 3_000_000
#: Pieces kept from batch to batch; beyond it the half learned first is forgotten.
REMEMBERED = 200_000
#: Texts of so many characters are taken together, however Arrow cuts them.
CHUNK_CHARACTERS = 4_000_000

_STEPS = """
WITH RECURSIVE step(word, pos, tok, round) AS (
    SELECT word, pos, tok, 0 FROM seed
    UNION ALL
    (
        WITH pairs AS (
            SELECT s.*, m.rank, m.merged
            FROM (SELECT word, pos, tok, round,
                         lead(tok) OVER w AS next_tok, lead(pos) OVER w AS next_pos
                  FROM step WINDOW w AS (PARTITION BY word ORDER BY pos)) s
            LEFT JOIN merges m ON m.first_tok = s.tok AND m.second_tok = s.next_tok
        ), cut AS (
            SELECT word, arg_min({'at': pos, 'gone': next_pos}, rank::BIGINT * 65536 + pos) AS pair
            FROM pairs WHERE rank IS NOT NULL GROUP BY word
        )
        SELECT p.word, p.pos, CASE WHEN p.pos = c.pair.at THEN p.merged ELSE p.tok END, p.round + 1
        FROM pairs p JOIN cut c USING (word)
        WHERE p.pos <> c.pair.gone
    )
)
SELECT word, list(tok ORDER BY pos) AS ids
FROM (SELECT * FROM step QUALIFY round = max(round) OVER (PARTITION BY word))
GROUP BY word
"""


def _byte_letters() -> dict[str, int]:
    """The published letters for bytes: printable ones stand for themselves, the rest follow from 256 on."""
    kept = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    letters = {chr(b): b for b in kept}
    rest = [b for b in range(256) if b not in set(kept)]
    return letters | {chr(256 + i): b for i, b in enumerate(rest)}


class Encoder:
    """Encodes batches of texts; one per Python worker and vocabulary."""

    def __init__(self, vocabulary: str = DEFAULT_VOCABULARY):
        import regex

        with open(vocabulary, encoding="utf-8") as f:
            model = json.load(f)["model"]
        ids, letters = model["vocab"], _byte_letters()
        self.words = regex.compile(PATTERN)
        self.of_byte = np.zeros(256, np.int32)
        self.never = np.ones((256, 256), bool)  # byte pairs inside no token
        for token, i in ids.items():
            try:
                raw = [letters[c] for c in token]
            except KeyError:  # a special token; its text is ordinary here
                continue
            if len(raw) == 1:
                self.of_byte[raw[0]] = i
            for a, b in zip(raw, raw[1:]):
                self.never[a, b] = False
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.merge = {(ids[a], ids[b]): (rank, ids[a + b]) for rank, (a, b) in enumerate(pairs)}
        self.token_bytes = {i: bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode() for token, i in ids.items()}
        self.known: dict[bytes, np.ndarray] = {}
        self._db = None

    def _connection(self):
        if self._db is None:
            import duckdb

            # No folder for spilling: it would be one machine's own.
            self._db = duckdb.connect(":memory:", config={"threads": 1, "memory_limit": "256MB", "temp_directory": ""})
            self._db.execute("SET preserve_insertion_order = false")
            first, second = np.array(list(self.merge), np.int32).T
            rank, merged = np.array(list(self.merge.values()), np.int32).T
            table = pa.table({"first_tok": first, "second_tok": second, "rank": rank, "merged": merged})
            self._db.register("given", table)
            self._db.execute("CREATE TABLE merges AS SELECT * FROM given")
            self._db.unregister("given")
            self._db.register("given", pa.table({"tok": pa.array(list(self.token_bytes), pa.int32()), "hex": [b.hex() for b in self.token_bytes.values()]}))
            self._db.execute("CREATE TABLE tokens AS SELECT * FROM given")
            self._db.unregister("given")
        return self._db

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> list[bytes]:
        """The bytes of each text of ids, by an ordered aggregation; an id that isn't in the vocabulary raises ValueError."""
        if len(ids) and not np.isin(ids, np.fromiter(self.token_bytes, np.int64, len(self.token_bytes))).all():
            raise ValueError("an id isn't in the vocabulary")
        db = self._connection()
        word = np.repeat(np.arange(len(counts), dtype=np.int32), counts)
        db.register("seed", pa.table({"word": word, "pos": np.arange(len(ids)), "tok": ids.astype(np.int32)}))
        found = db.sql("SELECT word, string_agg(hex, '' ORDER BY pos) AS hex FROM seed JOIN tokens USING (tok) GROUP BY word").to_arrow_table()
        db.unregister("seed")
        out = [b""] * len(counts)
        for k, hexed in zip(found.column("word").to_pylist(), found.column("hex").to_pylist()):
            out[k] = bytes.fromhex(hexed)
        return out

    def _by_heap(self, piece: bytes) -> list[int]:
        """The same contraction for one long piece, in n log n steps."""
        tok = [int(self.of_byte[b]) for b in piece]
        left, right = list(range(-1, len(tok) - 1)), list(range(1, len(tok) + 1))
        heap = []

        def offer(i: int) -> None:
            j = right[i]
            if j < len(tok) and (found := self.merge.get((tok[i], tok[j]))):
                heapq.heappush(heap, (found[0], i, tok[i], tok[j], found[1]))

        for i in range(len(tok) - 1):
            offer(i)
        while heap:
            _, i, a, b, merged = heapq.heappop(heap)
            j = right[i]
            if tok[i] != a or j >= len(tok) or tok[j] != b:
                continue
            tok[i], tok[j], right[i] = merged, -1, right[j]
            if right[j] < len(tok):
                left[right[j]] = i
            offer(i)
            if left[i] >= 0:
                offer(left[i])
        return [t for t in tok if t >= 0]

    def _learn(self, pieces: list[bytes]) -> None:
        """Ids of pieces that aren't known yet."""
        for piece in pieces:
            if len(piece) > LONGEST_PIECE:
                self.known[piece] = np.array(self._by_heap(piece), np.int32)
        short = [p for p in pieces if len(p) <= LONGEST_PIECE]
        blocks = np.cumsum(np.array([len(p) ** 2 for p in short], np.int64)) // SQUARES
        for block in np.split(np.arange(len(short)), np.flatnonzero(np.diff(blocks)) + 1):
            part = [short[k] for k in block]
            if not part:
                continue
            sizes = np.array([len(p) for p in part])
            starts = np.cumsum(sizes) - sizes
            raw = np.frombuffer(b"".join(part), np.uint8)
            word = np.repeat(np.arange(len(part), dtype=np.int32), sizes)
            pos = (np.arange(len(raw)) - np.repeat(starts, sizes)).astype(np.int32)
            db = self._connection()
            db.register("seed", pa.table({"word": word, "pos": pos, "tok": self.of_byte[raw]}))
            found = db.sql(_STEPS).to_arrow_table()
            db.unregister("seed")
            words, lists = found.column(0).to_numpy(), found.column(1).combine_chunks()
            offsets, values = lists.offsets.to_numpy(), lists.values.to_numpy(zero_copy_only=False).astype(np.int32)
            for w, a, b in zip(words, offsets[:-1], offsets[1:]):
                self.known[part[w]] = values[a:b]

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts on end, and the number of ids of each text."""
        if len(self.known) > REMEMBERED:
            self.known = dict(list(self.known.items())[len(self.known) // 2 :])
        cuts: list[int] = []  # byte positions at which words start
        blobs, at, bytes_of = [], 0, np.zeros(len(texts), np.int64)
        for k, text in enumerate(texts):
            if not text:
                continue
            blob = text.encode()
            bytes_of[k] = len(blob)
            blobs.append(blob)
            starts = [m.start() for m in self.words.finditer(text)]
            if len(blob) == len(text):
                cuts.extend(s + at for s in starts)
            else:
                lead = np.frombuffer(blob, np.uint8)
                of_character = np.flatnonzero((lead & 0xC0) != 0x80)
                cuts.extend((of_character[starts] + at).tolist())
            at += len(blob)
        if not at:
            return np.zeros(0, np.int32), np.zeros(len(texts), np.int64)
        whole = b"".join(blobs)
        raw = np.frombuffer(whole, np.uint8)
        begins = np.zeros(len(raw), bool)
        begins[cuts] = True
        begins[1:] |= self.never[raw[:-1], raw[1:]]
        starts = np.flatnonzero(begins)
        ends = np.append(starts[1:], len(raw))
        pieces = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(starts), [None, pa.py_buffer(np.append(starts, len(raw)).astype(np.int64)), pa.py_buffer(whole)]
        ).dictionary_encode()
        distinct = pieces.dictionary.to_pylist()
        self._learn([p for p in distinct if p not in self.known])
        ids = [self.known[p] for p in distinct]
        index = pieces.indices.to_numpy()
        size_of = np.array([len(x) for x in ids], np.int64)
        flat, begin_of = np.concatenate(ids), np.cumsum(size_of) - size_of
        sizes = size_of[index]
        out_starts = np.cumsum(sizes) - sizes
        take = np.arange(sizes.sum()) - np.repeat(out_starts - begin_of[index], sizes)
        before = np.append(0, np.cumsum(sizes))  # ids before each piece
        edges = np.append(0, np.cumsum(bytes_of))
        piece_at = np.searchsorted(starts, edges)
        counts = np.diff(before[piece_at])
        assert ends[-1] == len(raw)
        return flat[take], counts


_encoders: dict[str, Encoder] = {}


def encoder(vocabulary: str = DEFAULT_VOCABULARY) -> Encoder:
    """The worker's encoder for a vocabulary file, made on first use."""
    if vocabulary not in _encoders:
        _encoders[vocabulary] = Encoder(vocabulary)
    return _encoders[vocabulary]


def _parts(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    """Slices of about CHUNK_CHARACTERS characters, of one text at least."""
    start, size = 0, 0
    for k, text in enumerate(texts):
        size += len(text or "")
        if size >= CHUNK_CHARACTERS:
            yield start, k + 1
            start, size = k + 1, 0
    if start < len(texts):
        yield start, len(texts)


def encode_texts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = DEFAULT_VOCABULARY) -> DataFrame:
    """``id_col`` and ``ids ARRAY<INT>``: one row per row of ``df``, repeated rows included.

    A null or empty text has an empty list.  Strings that look like special
    tokens are ordinary text.  Other columns of ``df`` don't matter, whatever
    their names; an empty ``df`` gives an empty result.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = encoder(vocabulary)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for a, b in _parts(texts):
                ids, counts = made.encode(texts[a:b])
                lists = pa.ListArray.from_arrays(np.append(0, np.cumsum(counts)).astype(np.int32), pa.array(ids, pa.int32()))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), lists], [id_col, "ids"])

    schema = T.StructType([df.schema[id_col], T.StructField("ids", T.ArrayType(T.IntegerType(), True), True)])
    return df.select(id_col, text_col).mapInArrow(run, schema)


def token_counts(df: DataFrame, text_col: str, carry: list[str], vocabulary: str = DEFAULT_VOCABULARY) -> DataFrame:
    """Columns ``carry`` and ``n_tokens BIGINT``, the number of ids of the text; 0 for a null or empty one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = encoder(vocabulary)
        for batch in batches:
            texts = batch.column(len(carry)).to_pylist()
            for a, b in _parts(texts):
                _, counts = made.encode(texts[a:b])
                kept = [batch.column(i).slice(a, b - a) for i in range(len(carry))]
                yield pa.RecordBatch.from_arrays([*kept, pa.array(counts, pa.int64())], [*carry, "n_tokens"])

    schema = T.StructType([*(df.schema[c] for c in carry), T.StructField("n_tokens", T.LongType(), True)])
    return df.select(*carry, text_col).mapInArrow(run, schema)


def decode_ids(df: DataFrame, id_col: str = "doc_id", ids_col: str = "ids", vocabulary: str = DEFAULT_VOCABULARY) -> DataFrame:
    """``id_col`` and ``text``: the text of each row's ids, row for row.

    A null or empty list gives an empty text; bytes that are no UTF-8, as of a
    list cut within a character, become U+FFFD; an id that isn't in the
    vocabulary fails the query.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = encoder(vocabulary)
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                part = batch.slice(at, 2000)
                lists = [x or [] for x in part.column(1).to_pylist()]
                texts = made.decode(np.array([i for x in lists for i in x], np.int64), np.array([len(x) for x in lists]))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([t.decode("utf-8", "replace") for t in texts], pa.string())], [id_col, "text"])

    return df.select(id_col, ids_col).mapInArrow(run, T.StructType([df.schema[id_col], T.StructField("text", T.StringType(), True)]))
