"""Cross-tokenizer alignment on inverted pair bitmaps.

A text is encoded by two tokenizers. Where a token of each ends at the same
byte, both are cut; tokens between two cuts are a group, and all pairs of an
``A`` and a ``B`` token of a group are linked.

The index: documents are numbered inside blocks. For every id pair and block
there is a bitmap of the documents that have the pair linked, and
multiplicity planes: plane ``j`` holds bit ``j`` of how often beyond once.
Runs of documents are OR-merged into their block. The bitmap's population
count is the pair's documents; it and the planes' counts weighted by ``2**j``
are its links. A bitmap is kept as a list of places or as bits, whichever is
shorter. Blocks share no document, so a pair's counts add up over them, and
the blocks' postings give every document its scores from the sums.
"""

from __future__ import annotations

import hashlib
import json
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kindred.llm.common import staged
from kindred.llm.tokencount import PATTERN

FOLDER = "/opt/tokenizers"
BLOCK_DOCS = 1 << 12       # documents in a block, at most
BLOCK_POSTINGS = 1 << 20   # (pair, document) entries after which a block is closed
WIDE = 1 << 12             # links of a group beyond which its tokens are counted first
PIECE = 1 << 22            # links held at a time


def byte_decoder() -> dict[str, int]:
    """The byte each character of a byte-level vocabulary stands for:
    printable Latin-1 characters for themselves, the others in order from
    U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out = {chr(b): b for b in plain}
    out.update({chr(0x100 + n): b for n, b in enumerate(b for b in range(256) if b not in set(plain))})
    return out


class Encoder:
    """One side: token ids of texts, and the bytes of every id."""

    def __init__(self, names: list[bytes], encode):
        self.encode = encode
        self.bytes = names
        self.size = np.array([len(x) for x in names], dtype=np.int64)


def byte_level(path: str, pattern: str = PATTERN) -> Encoder:
    """A byte-level BPE in a ``tokenizers`` file; encodes space + text, the
    strings of special tokens as plain text. The file's vocabulary is run by
    ``tiktoken``, which merges by rank of the result: the same where merges
    are numbered in their order, as is checked here. Long runs of white space,
    which that library cannot cut, go to ``tokenizers`` itself."""
    with open(path, encoding="utf-8") as f:
        model = json.load(f)["model"]
    decode = byte_decoder()
    ids = {bytes(map(decode.__getitem__, t)): i for t, i in model["vocab"].items() if all(c in decode for c in t)}
    made = [model["vocab"]["".join(m.split(" ") if isinstance(m, str) else m)] for m in model["merges"]]
    if made != sorted(made) or len(ids) != len(model["vocab"]):
        raise ValueError(f"{path}: merges are not numbered in order")
    engine = tiktoken.Encoding("file", pat_str=pattern, mergeable_ranks=ids, special_tokens={})
    blank = re.compile(r"\s{256}")
    names = [b""] * (max(ids.values()) + 1)
    for name, i in ids.items():
        names[i] = name
    return Encoder(names, lambda texts: [whole_file(path).encode(" " + x, add_special_tokens=False).ids if blank.search(x)
                                         else engine.encode_ordinary(" " + x) for x in texts])


@lru_cache(maxsize=1)
def whole_file(path: str):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True
    return t


def sentence_pieces(path: str) -> Encoder:
    """A ``sentencepiece`` model with byte fallback, which adds the space."""
    from sentencepiece import SentencePieceProcessor

    p = SentencePieceProcessor(model_file=path)
    names = [bytes([int(p.id_to_piece(i)[3:5], 16)]) if p.is_byte(i) else p.id_to_piece(i).replace("▁", " ").encode()
             for i in range(p.get_piece_size())]
    return Encoder(names, lambda texts: p.encode(texts, num_threads=1))


class Aligner:
    """Groups and links of texts for two encoders; a run of documents at a time."""

    def __init__(self, a: Encoder, b: Encoder):
        self.a, self.b = a, b
        # What stands behind a token in the written groups: , inside, | or ; at the end of a side.
        self.text_a = np.array([f"{i}{c}" for i in range(len(a.bytes)) for c in ",|"], dtype=object)
        self.text_b = np.array([f"{i}{c}" for i in range(len(b.bytes)) for c in ",;"], dtype=object)
        self.width = len(b.bytes)

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids of both sides, one document after the other, and each document's
        number of either and of bytes; none where a text is null or empty or a
        side does not join to space + text."""
        some = [x for x in texts if x]
        sides = iter(zip(self.a.encode(some), self.b.encode(some)))
        x, y, count = [], [], np.zeros((3, len(texts)), dtype=np.int64)
        for i, text in enumerate(texts):
            if text:
                p, q = next(sides)
                whole = b" " + text.encode()
                if b"".join(map(self.a.bytes.__getitem__, p)) == whole == b"".join(map(self.b.bytes.__getitem__, q)):
                    x += p
                    y += q
                    count[:, i] = len(p), len(q), len(whole)
        return np.array(x, dtype=np.int64), np.array(y, dtype=np.int64), *count

    def groups(self, x, y, size) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """How many tokens of each side every group has, and its document.
        Documents end in both sides, so groups never cross them."""
        end_x, end_y = np.cumsum(self.a.size[x]), np.cumsum(self.b.size[y])
        ends = np.zeros((2, int(size.sum()) + 1), dtype=bool)
        ends[0, end_x] = True
        ends[1, end_y] = True
        cut = np.flatnonzero(ends[0] & ends[1])
        return (np.diff(np.searchsorted(end_x, cut, "right"), prepend=0), np.diff(np.searchsorted(end_y, cut, "right"), prepend=0),
                np.searchsorted(np.cumsum(size), cut, "left"))

    def written(self, x, y, nx, ny, tokens) -> list[str]:
        """Each document's groups as ``a1,a2|b1;a3|b2,b3``; ``tokens`` are the
        documents' numbers of tokens of both sides together."""
        code_x, code_y = 2 * x, 2 * y
        code_x[np.cumsum(nx) - 1] += 1
        code_y[np.cumsum(ny) - 1] += 1
        # Sides by turns: a group's A tokens stand behind all tokens of the groups before it.
        mine = np.zeros(len(x) + len(y), dtype=bool)
        mine[np.arange(len(x)) + np.repeat(np.cumsum(ny) - ny, nx)] = True
        words = np.empty(len(mine), dtype=object)
        words[mine] = self.text_a[code_x]
        words[~mine] = self.text_b[code_y]
        words, ends = words.tolist(), np.cumsum(tokens).tolist()
        return ["".join(words[i:j])[:-1] for i, j in zip([0, *ends], ends)]

    def pairs(self, x, y, nx, ny, doc) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``document, a * width + b, links`` of distinct linked pairs,
        ascending. Large groups are counted by id first, and links are
        expanded a bounded piece at a time."""
        start_x, start_y = np.cumsum(nx) - nx, np.cumsum(ny) - ny
        span = len(self.a.bytes) * self.width  # a document's range of keys
        wide = np.flatnonzero(nx * ny > WIDE)
        plain = np.flatnonzero(nx * ny <= WIDE)
        found = []
        links = np.cumsum(nx[plain] * ny[plain])
        for part in np.split(plain, np.searchsorted(links, np.arange(PIECE, links[-1], PIECE)) if len(links) else []):
            a = np.repeat(start_x[part], nx[part]) + within(nx[part])       # A tokens of these groups
            n = np.repeat(ny[part], nx[part])                                # links of each
            b = np.repeat(np.repeat(start_y[part], nx[part]), n) + within(n)
            key = np.repeat(np.repeat(doc[part], nx[part]) * span + x[a] * self.width, n) + y[b]
            found.append(np.unique(key, return_counts=True))
        for g in wide.tolist():
            a, ca = np.unique(x[start_x[g]:start_x[g] + nx[g]], return_counts=True)
            b, cb = np.unique(y[start_y[g]:start_y[g] + ny[g]], return_counts=True)
            step = max(1, PIECE // len(b))
            for at in range(0, len(a), step):
                key = doc[g] * span + a[at:at + step, None] * self.width + b
                found.append((key.ravel(), (ca[at:at + step, None] * cb).ravel()))
        key, many = found[0] if len(found) == 1 else add_up(*(np.concatenate(c) for c in zip(*found)))
        return key // span, key % span, many


def within(n: np.ndarray) -> np.ndarray:
    """0 .. n-1 for each of ``n``, one after the other."""
    ends = np.cumsum(n)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - n, n)


def add_up(key: np.ndarray, many: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ascending distinct keys and the sums of their numbers."""
    order = np.argsort(key, kind="stable")
    key, many = key[order], many[order]
    first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, dtype=np.int64)
    return key[first], (np.add.reduceat(many, first) if len(first) else many)


# ---- bitmaps ------------------------------------------------------------------

def pack(places: np.ndarray) -> bytes:
    """Ascending places below 2**16 as a compressed bitmap: 0 and 16-bit
    places, or 1 and the bits up to the last place."""
    if len(places) and 16 * len(places) > places[-1] + 8:
        bits = np.zeros(int(places[-1]) + 1, dtype=np.uint8)
        bits[places] = 1
        return b"\1" + np.packbits(bits, bitorder="little").tobytes()
    return b"\0" + places.astype("<u2").tobytes()


def unpack(bitmap: bytes) -> np.ndarray:
    if bitmap[0]:
        return np.flatnonzero(np.unpackbits(np.frombuffer(bitmap, dtype=np.uint8, offset=1), bitorder="little"))
    return np.frombuffer(bitmap, dtype="<u2", offset=1).astype(np.int64)


def bitmap_count(bitmap: bytes) -> int:
    """Population count."""
    if bitmap[0]:
        return int.from_bytes(bitmap[1:], "little").bit_count()
    return len(bitmap) // 2


def planes(places: np.ndarray, extra: np.ndarray) -> list[bytes]:
    """The bitmap of ``places``, and the bits of the numbers ``extra``."""
    most = int(extra.max())
    return [pack(places), *(pack(places[extra >> j & 1 == 1]) for j in range(most.bit_length()))]


def link_count(maps: list[bytes]) -> int:
    return bitmap_count(maps[0]) + sum(bitmap_count(p) << j for j, p in enumerate(maps[1:]))


def add_weights(maps: list[bytes], out: np.ndarray, each: int) -> None:
    """Adds ``each`` to ``out`` for every link of the documents in ``maps``."""
    out[unpack(maps[0])] += each
    for j, p in enumerate(maps[1:]):
        out[unpack(p)] += each << j


class Block:
    """Postings of the documents a task has read since the last block."""

    def __init__(self, number: int, width: int):
        self.number, self.width = number, width
        self.parts, self.docs, self.held = [], 0, 0

    def add(self, docs: int, place: np.ndarray, key: np.ndarray, many: np.ndarray):
        """``docs`` more documents; ``place`` counts from the first of them."""
        self.parts.append((place + self.docs, key, many))
        self.docs += docs
        self.held += len(key)

    def full(self) -> bool:
        return self.docs >= BLOCK_DOCS or self.held >= BLOCK_POSTINGS

    def postings(self):
        """Record batches ``block, a, b, n_docs, n_links, planes``: the runs'
        entries merged by pair."""
        place, key, many = (np.concatenate(c) for c in zip(*self.parts))
        order = np.argsort(key, kind="stable")  # documents stay in order
        place, key, more = place[order], key[order], many[order] - 1
        first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, dtype=np.int64)
        ends = np.r_[first[1:], len(key)].astype(np.int64)
        for at in range(0, len(first), 1 << 14):
            lo, hi = first[at:at + (1 << 14)], ends[at:at + (1 << 14)]
            maps = [planes(place[i:j], more[i:j]) for i, j in zip(lo.tolist(), hi.tolist())]
            yield pa.RecordBatch.from_arrays([
                pa.array(np.full(len(lo), self.number)), pa.array(key[lo] // self.width), pa.array(key[lo] % self.width),
                pa.array([bitmap_count(m[0]) for m in maps], pa.int64()), pa.array(list(map(link_count, maps)), pa.int64()),
                pa.array(maps, pa.list_(pa.binary()))], ["block", "a", "b", "n_docs", "n_links", "planes"])


POSTING = "block long, a long, b long, n_docs long, n_links long, planes array<binary>"
DOCUMENT = "place int, n_a long, n_b long, n_groups long, sum_links long, written string"


def index(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Stored rows of two kinds, told apart by ``place``: each document's
    ``doc_id, block, place, n_a, n_b, n_groups, sum_links, written`` (digest of
    its groups), and the blocks' postings (``POSTING``, ``place`` null)."""
    source = docs.select("doc_id", F.col("text").alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, {DOCUMENT}, {POSTING}"

    def run(batches):
        aligner = Aligner(byte_level(path_a), sentence_pieces(path_b))
        number = TaskContext.get().partitionId() << 32
        block = Block(number, aligner.width)
        for b in batches:
            for part in runs(b.column("text").to_pylist()):
                rows = b.slice(part.start, part.stop - part.start)
                x, y, n_a, n_b, size = aligner.encode(rows.column("text").to_pylist())
                nx, ny, doc = aligner.groups(x, y, size)
                links = np.zeros(rows.num_rows, dtype=np.int64)
                np.add.at(links, doc, nx * ny)
                written = [hashlib.sha256(w.encode()).hexdigest() if w else "" for w in aligner.written(x, y, nx, ny, n_a + n_b)]
                ids = rows.column("doc_id")
                yield filled([ids, *map(pa.array, (
                    block.docs + np.arange(rows.num_rows), n_a, n_b, np.bincount(doc, minlength=rows.num_rows), links, written,
                    np.full(rows.num_rows, block.number)))], True, ids.type)
                block.add(rows.num_rows, *aligner.pairs(x, y, nx, ny, doc))
                if block.full():
                    for p in block.postings():
                        yield filled(p.columns, False, ids.type)
                    block = Block(block.number + 1, aligner.width)
        if block.docs:
            for p in block.postings():
                yield filled(p.columns, False, ids.type)

    return staged(source.mapInArrow(run, schema), "alignment-index")


def runs(texts: list[str | None], docs: int = 64, chars: int = 1 << 18):
    """Slices of a batch of a bounded number of documents and characters."""
    start = held = 0
    for i, x in enumerate(texts):
        if i > start and (i - start >= docs or held + len(x or "") > chars):
            yield slice(start, i)
            start, held = i, 0
        held += len(x or "")
    if len(texts) > start:
        yield slice(start, len(texts))


def filled(columns, document: bool, id_type) -> pa.RecordBatch:
    """A batch of ``index`` from the columns of one kind of row."""
    names = ["doc_id", "place", "n_a", "n_b", "n_groups", "sum_links", "written", "block"] if document \
        else ["block", "a", "b", "n_docs", "n_links", "planes"]
    schema = pa.schema([("doc_id", id_type), ("place", pa.int32()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()),
                        ("sum_links", pa.int64()), ("written", pa.string()), ("block", pa.int64()), ("a", pa.int64()), ("b", pa.int64()),
                        ("n_docs", pa.int64()), ("n_links", pa.int64()), ("planes", pa.list_(pa.binary()))])
    given = dict(zip(names, columns))
    n = len(columns[0])
    return pa.RecordBatch.from_arrays([given[f.name].cast(f.type) if f.name in given else pa.nulls(n, f.type) for f in schema], schema=schema)


def pair_counts(indexed: DataFrame) -> DataFrame:
    """``a, b, n_docs, n_links, best`` by linked pair of the corpus; ``best``
    if no other pair of ``a`` is in more documents."""
    counts = staged(indexed.where("place IS NULL").groupBy("a", "b").agg(F.sum("n_docs").alias("n_docs"), F.sum("n_links").alias("n_links")),
                    "alignment-counts")
    most = counts.groupBy("a").agg(F.max("n_docs").alias("most"))
    return counts.join(most, "a").select("a", "b", "n_docs", "n_links", (F.col("n_docs") == F.col("most")).alias("best"))


def align(docs: DataFrame, path_a: str = f"{FOLDER}/byte_bpe_50k.json", path_b: str = f"{FOLDER}/piece_bpe_32k.model") -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum,
    groups_sha256`` for each row of ``docs``.

    ``n_best`` are the document's links whose pair is in as many documents as
    any pair of its ``A`` id; ``count_sum`` adds up the pairs' documents over
    the links. A document is a row: repeated ids and repeated rows count each
    time. A text that is null or empty, or which a tokenizer does not give
    back byte by byte, has no tokens: zeros, and '' as digest. Other columns
    of ``docs`` are ignored; an empty table gives no row.
    """
    indexed = index(docs, path_a, path_b)
    scored = indexed.where("place IS NULL").select("block", "a", "b", "planes") \
        .join(staged(pair_counts(indexed), "alignment-pairs"), ["a", "b"]).select(F.col("block").alias("home"), "n_docs", "best", "planes")
    people = indexed.where("place IS NOT NULL").select("doc_id", "block", "place", "n_a", "n_b", "n_groups", "sum_links", "written")

    def score(rows: pa.Table, postings: pa.Table) -> pa.Table:
        size = len(rows)
        best, total = np.zeros(size, dtype=np.int64), np.zeros(size, dtype=np.int64)
        for b in postings.to_batches():
            for n, ok, maps in zip(b.column("n_docs").to_pylist(), b.column("best").to_pylist(), b.column("planes").to_pylist()):
                add_weights(maps, total, n)
                if ok:
                    add_weights(maps, best, 1)
        place = rows.column("place").to_numpy()
        names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
        return pa.Table.from_arrays([*(rows.column(c) for c in ("doc_id", "n_a", "n_b", "n_groups", "sum_links")),
                                     pa.array(best[place]), pa.array(total[place]), rows.column("written")], names)

    kind = docs.schema["doc_id"].dataType.simpleString()
    return people.groupBy("block").cogroup(scored.groupBy("home")).applyInArrow(
        score, f"doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")
