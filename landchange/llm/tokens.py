"""Encoding texts with a public byte-level BPE tokenizer, and back.

Pre-tokenisation works on arrays of code points of many texts at once. Every code point gets a class with the little
lookahead the pattern needs (a contraction's length, the last blank of a run); a small automaton over these classes says
where pieces begin. Its transition functions compose associatively, so the arrays are cut into blocks: the blocks' functions
are composed side by side, a scan over the blocks gives each block's first state, and a second sweep marks the starts.
Pieces are then merged by rank, each distinct piece once per worker batch.
"""

from __future__ import annotations

import base64
import heapq
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, functions as F

TOKENIZER_FILE = "/opt/tokenizers/byte_bpe_50k.tiktoken"

#: Characters that one array sweep takes at most (a longer text makes a sweep of its own), pieces kept in a worker's cache,
#: and the longest piece that is kept.
SWEEP_CHARS, CACHE_PIECES, CACHE_BYTES = 500_000, 500_000, 128

# fixed values: the code points with the Unicode property White_Space
WHITE_SPACE = [9, 10, 11, 12, 13, 32, 133, 160, 5760, *range(8192, 8203), 8232, 8233, 8239, 8287, 12288]

# symbols: letter, number, other, apostrophe of a contraction of 2 or 3 characters, the last white space of a run before
# something else (a space or other), white space with more white space or the end behind it
LETTER, NUMBER, OTHER, SHORT, LONG, LAST_SPACE, LAST_BLANK, BLANK = range(8)
# states: what the next character would continue
FRESH, IN_LETTERS, IN_NUMBERS, IN_OTHERS, IN_BLANKS, AFTER_SPACE, TWO_LEFT, ONE_LEFT = range(8)


def _automaton() -> tuple[np.ndarray, np.ndarray]:
    """(next state, whether a piece begins) by [symbol, state]; symbols from 8 on are those of a text's first character."""
    after = np.zeros((16, 8), np.uint8)
    begins = np.ones((16, 8), bool)
    joins = {LETTER: IN_LETTERS, NUMBER: IN_NUMBERS, OTHER: IN_OTHERS, SHORT: IN_OTHERS, LONG: IN_OTHERS}
    for state in range(8):
        for symbol in range(8):
            if symbol in joins:
                begins[symbol, state] = state not in (joins[symbol], AFTER_SPACE)
                after[symbol, state] = joins[symbol]
                if begins[symbol, state] and symbol in (SHORT, LONG):
                    after[symbol, state] = ONE_LEFT if symbol == SHORT else TWO_LEFT
            elif symbol == BLANK:
                begins[symbol, state], after[symbol, state] = state != IN_BLANKS, IN_BLANKS
            else:
                after[symbol, state] = AFTER_SPACE if symbol == LAST_SPACE else FRESH
            if state in (TWO_LEFT, ONE_LEFT):
                begins[symbol, state], after[symbol, state] = False, ONE_LEFT if state == TWO_LEFT else FRESH
    for symbol in range(8):
        after[symbol + 8] = after[symbol, FRESH]
    return after, begins


# fixed values: ranges of letters and numbers that Unicode 16 added, after this Python's tables
NEW_IN_16 = [
    (0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3), (0x10D40, 0x10D85), (0x10EC2, 0x10EC4),
    (0x11380, 0x113D3), (0x116D0, 0x116E3), (0x11BC0, 0x11BF9), (0x13460, 0x143FA), (0x16100, 0x16139), (0x16D40, 0x16D79),
    (0x18CFF, 0x18CFF), (0x1CCF0, 0x1CCF9), (0x1E5D0, 0x1E5FA),
]


def _kind(char: str) -> int:
    """Letter, number or other."""
    category = unicodedata.category(char)
    if category == "Cn" and any(a <= ord(char) <= b for a, b in NEW_IN_16):
        return LETTER if regex.match(r"\p{L}", char) else NUMBER if regex.match(r"\p{N}", char) else OTHER
    return {"L": LETTER, "N": NUMBER}.get(category[0], OTHER)


def symbols(points: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Symbol of each code point; first: where texts begin."""
    known, place = np.unique(points, return_inverse=True)
    blank_set = np.array(WHITE_SPACE)
    kinds = np.array([_kind(chr(c)) for c in known.tolist()], np.uint8)
    kinds[np.isin(known, blank_set)] = BLANK
    out = kinds[place.ravel()] if len(known) else np.zeros(0, np.uint8)
    n = len(points)
    starts = np.append(first, np.ones(3, bool))
    ahead = np.append(points, np.zeros(3, points.dtype))
    one = np.where(starts[1 : n + 1], 0, ahead[1 : n + 1])
    two = np.where(starts[1 : n + 1] | starts[2 : n + 2], 0, ahead[2 : n + 2])
    quote = points == ord("'")
    # fixed values: the contractions of the pattern, 's 't 'm 'd and 're 've 'll
    out[quote & np.isin(one, [ord(c) for c in "stmd"])] = SHORT
    for pair in ("re", "ve", "ll"):
        out[quote & (one == ord(pair[0])) & (two == ord(pair[1]))] = LONG
    text_behind = ~starts[1 : n + 1] & (np.append(out[1:], BLANK) != BLANK)
    last = (out == BLANK) & text_behind
    out[last] = np.where(points[last] == 32, LAST_SPACE, LAST_BLANK)
    return out


def piece_starts(points: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Where pieces begin, by a blockwise scan of the automaton's transition functions."""
    after, begins = _automaton()
    symbol = symbols(points, first) + 8 * first.astype(np.uint8)
    n = len(symbol)
    width = max(1, int(np.sqrt(n)))
    blocks = -(-n // width)
    grid = np.zeros(blocks * width, np.uint8)
    grid[:n] = symbol
    columns = np.ascontiguousarray(grid.reshape(blocks, width).T)
    function = np.tile(np.arange(8, dtype=np.uint8), (blocks, 1))
    for column in columns:  # every block's composed function, all blocks side by side
        function = after[column[:, None], function]
    state = np.zeros(blocks, np.uint8)
    for b in range(1, blocks):
        state[b] = function[b - 1, state[b - 1]]
    marks = np.empty((width, blocks), bool)
    for i, column in enumerate(columns):
        marks[i] = begins[column, state]
        state = after[column, state]
    return (marks.T.ravel()[:n]) | first


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Token ids of a piece: neighbours whose joined bytes rank lowest merge first, the leftmost of equals."""
    whole = ranks.get(piece)
    if whole is not None:
        return [whole]
    n = len(piece)
    end, prev = list(range(1, n + 1)), list(range(-1, n - 1))
    alive = [True] * n
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(piece[i : i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, j = heapq.heappop(heap)
        if not alive[i] or end[i] >= j or end[i] == n or end[end[i]] != j:
            continue
        alive[end[i]] = False
        end[i] = j
        if j < n:
            prev[j] = i
            if (r := ranks.get(piece[i : end[j]])) is not None:
                heapq.heappush(heap, (r, i, end[j]))
        if (p := prev[i]) >= 0 and (r := ranks.get(piece[p:j])) is not None:
            heapq.heappush(heap, (r, p, j))
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i : end[i]]])
        i = end[i]
    return out


class Encoder:
    """Encodes lists of texts; one per task."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.cache: dict[bytes, list[int]] = {}

    def encode(self, texts: list[str | None]) -> list[list[int]]:
        """Token ids of each text; none for null and empty ones."""
        out: list[list[int]] = [[] for _ in texts]
        sweep: list[int] = []
        held = 0
        for i, text in enumerate(texts):
            if text:
                if sweep and held + len(text) > SWEEP_CHARS:
                    self._sweep(texts, sweep, out)
                    sweep, held = [], 0
                sweep.append(i)
                held += len(text)
        if sweep:
            self._sweep(texts, sweep, out)
        return out

    def _sweep(self, texts: list, which: list[int], out: list[list[int]]) -> None:
        joined = "".join([texts[i] for i in which])
        points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        lengths = np.array([len(texts[i]) for i in which])
        first = np.zeros(len(points), bool)
        begin = np.cumsum(lengths) - lengths
        first[begin] = True
        at = np.flatnonzero(piece_starts(points, first))
        size = np.ones(len(points), np.int64) + (points > 0x7F) + (points > 0x7FF) + (points > 0xFFFF)
        offset = np.append(0, np.cumsum(size))
        bounds = offset[np.append(at, len(points))].tolist()
        owner = np.append(np.searchsorted(at, begin), len(at)).tolist()
        data = joined.encode("utf-8", "surrogatepass")
        cache, ranks = self.cache, self.ranks
        for k, i in enumerate(which):
            ids = out[i]
            for p in range(owner[k], owner[k + 1]):
                piece = data[bounds[p] : bounds[p + 1]]
                got = cache.get(piece)
                if got is None:
                    got = merge(piece, ranks)
                    if len(piece) <= CACHE_BYTES:
                        if len(cache) >= CACHE_PIECES:
                            cache.clear()
                        cache[piece] = got
                ids += got


def _id_array(rows: list[list[int]]) -> pa.Array:
    ends = np.cumsum([0, *map(len, rows)]).astype(np.int32)
    flat = np.fromiter((x for r in rows for x in r), np.int32, int(ends[-1]))
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))


def encode(df: DataFrame, key: str, text: str, tokenizer: str = TOKENIZER_FILE, offsets: bool = False) -> DataFrame:
    """(key, ids ARRAY<INT>): every text's token ids, without special tokens.

    Null and empty texts have the empty list. With `offsets`, ends ARRAY<INT> has the byte of the text's UTF-8 after each
    token. Strings of special tokens inside a text are ordinary text. tokenizer is a file of base64 tokens and ranks that
    every executor can read. Equal rows come out as often as they came in; other columns of df are left out.
    """
    kind = df.schema[key].dataType.simpleString()
    source = df.select(F.col(key).alias("_key"), F.col(text).alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = load_ranks(tokenizer)
        encoder = Encoder(ranks)
        sizes = np.zeros(max(ranks.values()) + 1, np.int32)
        for token, rank in ranks.items():
            sizes[rank] = len(token)
        for batch in batches:
            for part in _by_chars(batch):
                ids = encoder.encode(part.column(1).to_pylist())
                columns, names = [part.column(0), _id_array(ids)], ["_key", "ids"]
                if offsets:
                    columns.append(_id_array([np.cumsum(sizes[x]).tolist() if x else [] for x in ids]))
                    names.append("ends")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    ddl = f"_key {kind}, ids ARRAY<INT>" + (", ends ARRAY<INT>" if offsets else "")
    return source.mapInArrow(run, ddl).withColumnRenamed("_key", key)


def token_counts(df: DataFrame, key: str, text: str, keep: list[str] = [], tokenizer: str = TOKENIZER_FILE) -> DataFrame:
    """(key, *keep, tokens BIGINT): how many tokens each text has; null and empty texts have 0."""
    packed = df.select(F.struct(F.col(key).alias("k"), *(F.col(c).alias(f"c{i}") for i, c in enumerate(keep))).alias("_key"), F.col(text).alias("_text"))
    kind = packed.schema["_key"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(load_ranks(tokenizer))
        for batch in batches:
            for part in _by_chars(batch):
                counts = [len(x) for x in encoder.encode(part.column(1).to_pylist())]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(counts, pa.int64())], names=["_key", "tokens"])

    counted = packed.mapInArrow(run, f"_key {kind}, tokens BIGINT")
    return counted.select(F.col("_key.k").alias(key), *(F.col(f"_key.c{i}").alias(c) for i, c in enumerate(keep)), "tokens")


def _by_chars(batch: pa.RecordBatch, most: int = 8_000_000) -> Iterator[pa.RecordBatch]:
    """A batch in slices of about `most` bytes of text at most, or of one row."""
    sizes = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False)
    begin, held = 0, 0
    for i, size in enumerate(sizes):
        if held and held + size > most:
            yield batch.slice(begin, i - begin)
            begin, held = i, 0
        held += size
    if begin < len(sizes):
        yield batch.slice(begin)


def decode(df: DataFrame, key: str, ids: str = "ids", tokenizer: str = TOKENIZER_FILE) -> DataFrame:
    """(key, text): the texts of id lists. A null list gives null, an empty one the empty text; ids that aren't in the
    vocabulary and bytes that are no UTF-8 become replacement characters."""
    kind = df.schema[key].dataType.simpleString()
    source = df.select(F.col(key).alias("_key"), F.col(ids).alias("_ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = {rank: token for token, rank in load_ranks(tokenizer).items()}
        for batch in batches:
            texts = [None if x is None else b"".join(tokens.get(t, b"\xff") for t in x).decode("utf-8", "replace") for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["_key", "text"])

    return source.mapInArrow(run, f"_key {kind}, text STRING").withColumnRenamed("_key", key)
