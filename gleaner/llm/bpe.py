"""Byte-level BPE encoding and decoding with segment-tree merges.

A piece (one match of the split pattern) is merged by a segment tree over its
byte positions.  A leaf holds the rank of the pair that starts at that live
part (or NONE), an inner node the smaller of its children, the left one on
ties, so the root is the leftmost pair of least rank.  A merge changes the
pair that starts at the merged part and the one before it and kills the right
part: three logarithmic point updates.  Ranks are looked up per pair of part
ids.

Pieces of up to ``LANE`` bytes run many at a time: one tree per row of a
matrix, all rows merging in step (``encode_lanes``).  Longer pieces run one at
a time on the same tree (``encode_long``), O(n log n) each.  A piece that is
itself in the vocabulary is that one id, as in the public library.

Texts are encoded inside an Arrow UDF; each Python worker keeps a bounded map
of pieces already encoded.  Nothing is shuffled.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LANE = 32                # longest piece, in bytes, of the batched trees
KEPT_PIECES = 150_000    # pieces a worker remembers before it starts afresh
_NONE = np.int32((1 << 22) - 1)   # above every rank; rank << 8 | position fits 31 bits


class Vocabulary:
    """Ranks of byte strings, and of every pair of them that joins to one."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens: list[bytes] = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token
        self.of_byte = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        # (left id, right id) of every split of a token into two tokens, as an open-addressing table
        keys, merged = [], []
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    keys.append(left << 20 | right)
                    merged.append(rank)
        order = np.argsort(np.array(keys, np.int64), kind="stable")
        keys_sorted = np.array(keys, np.int64)[order]
        self.pair = dict(zip(keys, merged))
        self.shift = np.uint64(64 - max(4, int(len(keys) * 4).bit_length()))
        size = 1 << (64 - int(self.shift))
        self.slot_key = np.full(size, -1, np.int64)
        self.slot_rank = np.full(size, _NONE, np.int32)
        rank_sorted = np.array(merged, np.int32)[order]
        self.probes = 1
        pending, step = np.arange(len(keys_sorted)), 0
        while len(pending):
            at = (self._slot(keys_sorted[pending]) + step) & (size - 1)
            free = self.slot_key[at] == -1
            _, firsts = np.unique(at[free], return_index=True)
            put = pending[free][firsts]
            self.slot_key[at[free][firsts]] = keys_sorted[put]
            self.slot_rank[at[free][firsts]] = rank_sorted[put]
            pending = np.setdiff1d(pending, put, assume_unique=True)
            step += 1
        self.probes = step
        self.mask = size - 1

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of the token that two parts join to, NONE where none."""
        keys = left << 20 | right
        at = self._slot(keys)
        found = self.slot_key[at]
        out = np.where(found == keys, self.slot_rank[at], _NONE)
        open_ = np.flatnonzero((found != keys) & (found != -1))
        for _ in range(1, self.probes):
            if not len(open_):
                break
            at[open_] = (at[open_] + 1) & self.mask
            found = self.slot_key[at[open_]]
            hit = found == keys[open_]
            out[open_[hit]] = self.slot_rank[at[open_[hit]]]
            open_ = open_[~hit & (found != -1)]
        return out

    @classmethod
    def read(cls, path: str) -> "Vocabulary":
        with open(path, "rb") as lines:
            return cls({base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())})


def _update(tree: np.ndarray, base: np.ndarray, width: int, at: np.ndarray, value) -> None:
    """Point update of one leaf of the trees that start at ``base``, and of
    its ancestors."""
    node = at + width
    tree[base + node] = value
    while width > 1:                      # all leaves are at one depth
        node >>= 1
        width >>= 1
        pair = base + (node << 1)
        tree[base + node] = np.minimum(tree[pair], tree[pair + 1])


def encode_lanes(pieces: list[bytes], vocab: Vocabulary) -> tuple[bytes, np.ndarray]:
    """Ids of many pieces of at most LANE bytes, merging in step: all ids as
    little-endian 32-bit integers, and the number of ids of each piece."""
    n = len(pieces)
    sizes = np.fromiter(map(len, pieces), np.int32, n)
    width = 1 << max(1, int(sizes.max() - 1).bit_length())
    flat = np.frombuffer(b"".join(pieces), np.uint8)
    first = np.arange(n, dtype=np.int32) * width
    cells = np.arange(len(flat), dtype=np.int32) + np.repeat(first - (np.cumsum(sizes, dtype=np.int32) - sizes), sizes)
    ids = np.full(n * width, -1, np.int64)
    ids[cells] = vocab.of_byte[flat]
    after = np.tile(np.arange(1, width + 1, dtype=np.int32), n)        # next live part
    before = np.tile(np.arange(-1, width - 1, dtype=np.int32), n)      # live part before
    none = np.int32(_NONE << 8)
    # node value: rank << 8 | position, so the minimum is the leftmost least
    ranks = np.full(n * width, _NONE, np.int32)
    inner = np.ones(len(cells), bool)
    inner[np.cumsum(sizes) - 1] = False
    ranks[cells[inner]] = vocab.pair_ranks(ids[cells[inner]], ids[cells[inner] + 1])
    tree = np.full((n, 2 * width), none, np.int32)
    tree[:, width:] = (ranks << 8).reshape(n, width) | np.arange(width, dtype=np.int32)
    for level in range(width.bit_length() - 2, -1, -1):
        lo, hi = 1 << level, 2 << level
        tree[:, lo:hi] = np.minimum(tree[:, 2 * lo:2 * hi:2], tree[:, 2 * lo + 1:2 * hi:2])
    tree = tree.reshape(-1)
    dead = np.ones(n * width, bool)
    dead[cells] = False
    live = np.arange(n, dtype=np.int32)
    while True:
        root = tree[live * (2 * width) + 1]
        more = root < none
        live, root = live[more], root[more]
        if not len(live):
            break
        row, base, size = live * width, live * (2 * width), sizes[live]
        at = root & 255
        cell = row + at
        right = after[cell]
        ids[cell] = root >> 8
        dead[row + right] = True
        nxt = after[row + right]
        after[cell] = nxt
        tail = np.flatnonzero(nxt < size)
        behind = row[tail] + nxt[tail]
        before[behind] = at[tail]
        # the pair that starts at the merged part, the dead part, the pair before
        rank = np.full(len(live), none, np.int32)
        rank[tail] = vocab.pair_ranks(ids[cell[tail]], ids[behind]) << 8 | at[tail]
        _update(tree, base, width, at, rank)
        _update(tree, base, width, right, none)
        prev = before[cell]
        has = np.flatnonzero(prev >= 0)
        p = prev[has]
        _update(tree, base[has], width, p, vocab.pair_ranks(ids[row[has] + p], ids[cell[has]]) << 8 | p)
    counts = (~dead).reshape(n, width).sum(1)
    return ids[~dead].astype("<u4").tobytes(), counts


def encode_long(piece: bytes, vocab: Vocabulary) -> np.ndarray:
    """Ids of one piece of any length by the same tree."""
    size = len(piece)
    width = 1 << max(1, (size - 1).bit_length())
    none, pair = int(_NONE), vocab.pair
    ids = [int(vocab.of_byte[b]) for b in piece]
    after, before = list(range(1, size + 1)), list(range(-1, size - 1))
    top = (none, 0)
    tree = [top] * (2 * width)
    for i in range(size - 1):
        tree[width + i] = (pair.get(ids[i] << 20 | ids[i + 1], none), i)
    for node in range(width - 1, 0, -1):
        tree[node] = min(tree[2 * node], tree[2 * node + 1])

    def put(at: int, rank: int) -> None:
        node = at + width
        tree[node] = (rank, at)
        node >>= 1
        while node:
            tree[node] = min(tree[2 * node], tree[2 * node + 1])
            node >>= 1

    dead = bytearray(size)
    while tree[1][0] < none:
        rank, at = tree[1]
        right = after[at]
        ids[at], dead[right] = rank, 1
        nxt = after[at] = after[right]
        if nxt < size:
            before[nxt] = at
            put(at, pair.get(ids[at] << 20 | ids[nxt], none))
        else:
            put(at, none)
        put(right, none)
        if before[at] >= 0:
            put(before[at], pair.get(ids[before[at]] << 20 | ids[at], none))
    return np.array([x for x, d in zip(ids, dead) if not d], "<u4")


class Tokenizer:
    """Encoder and decoder of one worker, with its bounded piece map."""

    def __init__(self, path: str, pattern: str):
        import regex

        self.vocab = Vocabulary.read(path)
        self.split = regex.compile(pattern)
        self.known: dict[str, bytes] = {}

    def _learn(self, pieces: set[str]) -> None:
        if len(self.known) + len(pieces) > KEPT_PIECES:
            self.known.clear()
        known, whole_of = self.known, self.vocab.ranks.get
        lanes: dict[int, tuple[list[str], list[bytes]]] = {}
        for piece in pieces:
            raw = piece.encode("utf-8", "surrogatepass")
            whole = whole_of(raw)
            if whole is not None:
                known[piece] = whole.to_bytes(4, "little")
            elif len(raw) > LANE:
                known[piece] = encode_long(raw, self.vocab).tobytes()
            else:
                lane = lanes.setdefault((len(raw) - 1).bit_length(), ([], []))
                lane[0].append(piece)
                lane[1].append(raw)
        for names, raws in lanes.values():
            for a in range(0, len(names), 20_000):
                ids, counts = encode_lanes(raws[a:a + 20_000], self.vocab)
                ends = (np.cumsum(counts) * 4).tolist()
                for piece, lo, hi in zip(names[a:a + 20_000], [0, *ends], ends):
                    known[piece] = ids[lo:hi]

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        pieces = [self.split.findall(t) for t in texts]
        seen = set().union(*pieces)
        known = self.known
        new = {p for p in seen if p not in known}
        if len(self.known) + len(new) > KEPT_PIECES:
            new = seen                     # the map starts afresh
        if new:
            self._learn(new)
        get = self.known.__getitem__
        return [b"".join(map(get, ps)) for ps in pieces]

    def decode(self, ids: bytes) -> bytes:
        tokens = self.vocab.tokens
        return b"".join([tokens[i] for i in np.frombuffer(ids, "<u4").tolist()])


_LOADED: dict[tuple[str, str], Tokenizer] = {}


def tokenizer(path: str, pattern: str) -> Tokenizer:
    """The worker's tokenizer of this file; the newest one is kept."""
    if (path, pattern) not in _LOADED:
        _LOADED.clear()
        _LOADED[path, pattern] = Tokenizer(path, pattern)
    return _LOADED[path, pattern]


def _text_groups(texts: pa.Array, chars: int = 1 << 20) -> Iterator[list[str]]:
    group, size = [], 0
    for t in texts:
        s = t.as_py() or ""
        group.append(s)
        size += len(s)
        if size >= chars:
            yield group
            group, size = [], 0
    if group:
        yield group


def encode_udf(path: str, pattern: str):
    """Column function text -> array<int> of ids; null text gives []."""
    @F.arrow_udf("array<int>")
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tok = tokenizer(path, pattern)
        for texts in batches:
            for group in _text_groups(texts):          # as many rows out as in, a few texts at a time
                out = tok.encode_batch(group)
                offsets = np.concatenate(([0], np.cumsum([len(x) // 4 for x in out]))).astype(np.int32)
                yield pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(out), "<i4"), pa.int32()))
    return encode


def digest_udf(path: str, pattern: str):
    """Column function text -> (n_tokens, ids_sha256, decoded_sha256): the
    text is encoded, and the ids decoded again, as a whole."""
    schema = "n_tokens long, ids_sha256 string, decoded_sha256 string"

    @F.arrow_udf(schema)
    def digest(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tok = tokenizer(path, pattern)
        for texts in batches:
            counts, ids_hex, text_hex = [], [], []
            for group in _text_groups(texts):
                for ids in tok.encode_batch(group):
                    counts.append(len(ids) // 4)
                    ids_hex.append(hashlib.sha256(ids).hexdigest())
                    text_hex.append(hashlib.sha256(tok.decode(ids)).hexdigest())
            yield pa.StructArray.from_arrays([pa.array(counts, pa.int64()), pa.array(ids_hex, pa.string()),
                                              pa.array(text_hex, pa.string())],
                                             ["n_tokens", "ids_sha256", "decoded_sha256"])
    return digest


def encode_documents(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, source, n_tokens and token ids of every document, in its order.

    Null and empty texts give no tokens; repeated rows are encoded each."""
    ids = encode_udf(path, pattern)(docs["text"])
    tokens = docs.select(F.col("doc_id").alias("doc_id"), F.col("source").alias("source"), ids.alias("tokens"))
    return tokens.select("doc_id", "source", F.size("tokens").cast("long").alias("n_tokens"), "tokens")


def token_digests(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every document."""
    d = docs.select(F.col("doc_id").alias("doc_id"), digest_udf(path, pattern).asNondeterministic()(docs["text"]).alias("d"))
    return d.select("doc_id", "d.n_tokens", "d.ids_sha256", "d.decoded_sha256")


def decode_documents(tokens: DataFrame, path: str, pattern: str, ids: str = "tokens", out: str = "text") -> DataFrame:
    """Add the decoded text of an id column (bytes that are no whole
    character become the replacement sign; null ids give null)."""
    @F.arrow_udf("string")
    def decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tok = tokenizer(path, pattern)
        for lists in batches:
            yield pa.array([None if x.as_py() is None else
                            tok.decode(np.array(x.as_py(), "<u4").tobytes()).decode("utf-8", "replace") for x in lists], pa.string())
    return tokens.withColumn(out, decode(F.col(ids)))
