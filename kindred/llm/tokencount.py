"""Edit-aware token counts.

A document's token count is kept as a segment tree over its pre-tokens: the
leaves are blocks of pre-tokens (length in characters, number of tokens),
the nodes hold sums of both. An edit finds its place by the character sums,
runs the pre-tokeniser again from a boundary a little before the edit until
it meets an old boundary behind it, encodes only those pre-tokens, replaces
their blocks and updates the sums on the paths above.

Why this is exact: the pre-token pattern has no look-behind, so what it cuts
from a boundary on depends on the text behind it only, and a pre-token is
decided at most ``CONTEXT`` characters behind its end. Tokens never cross
pre-tokens.
"""

from __future__ import annotations

import base64
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame

from kindred.llm import pii

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: the pre-token pattern this vocabulary goes with.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
CONTEXT = 3
BLOCK = 64           # pre-tokens a leaf starts with
READ = 1 << 20       # characters cut into pre-tokens at a time
CACHE = 1 << 18      # pre-tokens whose counts a worker remembers


class Tokenizer:
    """Pre-tokens of a text and token counts of pre-tokens."""

    def __init__(self, path: str, pattern: str = PATTERN):
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        self.cut = regex.compile(pattern)
        self.piece = tiktoken.Encoding("piece", pat_str=r"(?s:.+)", mergeable_ranks=ranks, special_tokens={})
        self.counts: dict[str, int] = {}

    def blocks(self, text: str):
        """Lists of pre-tokens, in order; together they are the text."""
        at, size = 0, READ
        while at < len(text):
            found = self.cut.findall(text, at, at + size)
            if at + size < len(text):  # what is cut near the end may be decided by what follows
                end = at + sum(map(len, found))
                while found and end > at + size - CONTEXT:
                    end -= len(found.pop())
                if not found:
                    size *= 2
                    continue
            yield found
            at, size = at + sum(map(len, found)), READ

    def count(self, pieces: list[str]) -> list[int]:
        get, out = self.counts.get, []
        for p in pieces:
            n = get(p)
            if n is None:
                n = len(self.piece.encode_ordinary(p))
                if len(self.counts) >= CACHE:
                    self.counts.clear()
                if len(p) <= 64:
                    self.counts[p] = n
            out.append(n)
        return out


@lru_cache(maxsize=2)
def tokenizer(path: str) -> Tokenizer:
    return Tokenizer(path)


class TokenTree:
    """Leaves are blocks ``(lengths, counts)`` of pre-tokens; ``chars`` and
    ``tokens`` are the sums of a binary tree over them, root at 1."""

    def __init__(self, lengths: np.ndarray, counts: np.ndarray):
        n = max(1, -(-len(lengths) // BLOCK))
        self.size = 1 << (n - 1).bit_length()
        self.blocks = [(lengths[k:k + BLOCK], counts[k:k + BLOCK]) for k in range(0, n * BLOCK, BLOCK)]
        self.chars, self.tokens = (self._sums(v, n) for v in (lengths, counts))

    def _sums(self, values: np.ndarray, n: int) -> np.ndarray:
        out = np.zeros(2 * self.size, dtype=np.int64)
        padded = np.zeros(n * BLOCK, dtype=np.int64)
        padded[:len(values)] = values
        out[self.size:self.size + n] = padded.reshape(n, BLOCK).sum(axis=1)
        level = self.size
        while level > 1:
            out[level // 2:level] = out[level:2 * level:2] + out[level + 1:2 * level:2]
            level //= 2
        return out

    def total(self) -> int:
        return int(self.tokens[1])

    def block_at(self, pos: int) -> tuple[int, int]:
        """Block that holds character ``pos`` (the last one, if beyond) and
        the place where it starts."""
        node, start = 1, 0
        while node < self.size:
            left = int(self.chars[2 * node])
            if pos < start + left or self.chars[2 * node + 1] == 0:
                node = 2 * node
            else:
                node, start = 2 * node + 1, start + left
        return node - self.size, start

    def starts(self, block: int, start: int) -> np.ndarray:
        """Places where the block's pre-tokens start, then where it ends."""
        return start + np.concatenate([[0], np.cumsum(self.blocks[block][0], dtype=np.int64)])

    def put(self, block: int, lengths, counts) -> None:
        """Replaces a block and updates the sums above it."""
        self.blocks[block] = (np.asarray(lengths, dtype=np.int64), np.asarray(counts, dtype=np.int64))
        node = block + self.size
        self.chars[node], self.tokens[node] = self.blocks[block][0].sum(), self.blocks[block][1].sum()
        while node > 1:
            node //= 2
            self.chars[node] = self.chars[2 * node] + self.chars[2 * node + 1]
            self.tokens[node] = self.tokens[2 * node] + self.tokens[2 * node + 1]

    def leaves(self) -> tuple[np.ndarray, np.ndarray]:
        return tuple(np.concatenate([np.asarray(b[k], dtype=np.int64) for b in self.blocks]) for k in (0, 1))

    def to_bytes(self) -> bytes:
        """Number of pre-tokens and item sizes, lengths, counts."""
        lengths, counts = self.leaves()
        kinds = [np.dtype(np.min_scalar_type(int(v.max(initial=0)))) for v in (lengths, counts)]
        head = np.array([len(lengths), *(k.itemsize for k in kinds)], dtype="<i8").tobytes()
        return head + lengths.astype(kinds[0]).tobytes() + counts.astype(kinds[1]).tobytes()

    @staticmethod
    def from_bytes(data: bytes) -> TokenTree:
        n, a, b = (int(x) for x in np.frombuffer(data, dtype="<i8", count=3))
        lengths = np.frombuffer(data, dtype=f"<u{a}", count=n, offset=24)
        return TokenTree(lengths, np.frombuffer(data, dtype=f"<u{b}", count=n, offset=24 + n * a))


def build_tree(text: str | None, tok: Tokenizer) -> TokenTree:
    lengths, counts = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)]
    for found in tok.blocks(text or ""):
        lengths.append(np.fromiter(map(len, found), dtype=np.int64, count=len(found)))
        counts.append(np.array(tok.count(found), dtype=np.int64))
    return TokenTree(np.concatenate(lengths), np.concatenate(counts))


def edited(text: str, edits: list[tuple[int, int, str]]) -> str:
    """``text`` after non-overlapping edits ``(start, end, replacement)``,
    sorted by start, all in places of the text before any of them."""
    out, at = [], 0
    for a, b, s in edits:
        out += [text[at:a], s]
        at = b
    return "".join([*out, text[at:]])


def checked(edits, size: int) -> list[tuple[int, int, str]]:
    """Edits by place, cut to the text; null replacements delete. Of two that
    overlap the later one is dropped."""
    out = []
    for a, b, s in sorted((max(0, min(a, size)), max(0, min(b, size)), s or "") for a, b, s in edits if a is not None and b is not None):
        if b >= a and (not out or a >= out[-1][1] and (a, b) != out[-1][:2]):
            out.append((a, b, s))
    return out


def apply_edits(tree: TokenTree, text: str, edits: list[tuple[int, int, str]], tok: Tokenizer) -> tuple[str, int]:
    """Applies ``checked`` edits to the tree, from the first to the last;
    returns the new text and the number of pre-tokens encoded again.

    Places before an edit are final when it is its turn, so there the tree
    and the new text agree. An edit that the pre-tokeniser comes near before
    it has met an old boundary is taken into the same run.
    """
    new, recoded, shift, k = edited(text, edits), 0, 0, 0
    while k < len(edits):
        near = max(0, edits[k][0] + shift - CONTEXT)
        first, at = tree.block_at(near)
        starts = tree.starts(first, at)
        keep = min(len(starts) - 1, int(np.searchsorted(starts, near, side="right")) - 1)
        pos, own, behind, pieces = int(starts[keep]), 0, -1, []
        while True:
            if k < len(edits) and pos > edits[k][0] + shift + own - CONTEXT:
                a, b, s = edits[k]
                own, behind, k = own + len(s) - (b - a), b + shift, k + 1
                continue
            if pos - own >= behind >= 0:
                last, at = tree.block_at(pos - own)
                ends = tree.starts(last, at)
                rest = int(np.searchsorted(ends, pos - own))
                if rest < len(ends) and ends[rest] == pos - own:
                    break
            pieces.append(tok.cut.match(new, pos).group())
            pos += len(pieces[-1])
        recoded += len(pieces)
        head, tail = tree.blocks[first], tree.blocks[last]
        made = (np.array([len(x) for x in pieces], dtype=np.int64), np.array(tok.count(pieces), dtype=np.int64))
        for n in range(first + 1, last + 1):
            tree.put(n, [], [])
        tree.put(first, *(np.concatenate([head[i][:keep], made[i], tail[i][rest:]]) for i in (0, 1)))
        shift += own
    if max(len(b[0]) for b in tree.blocks) > 16 * BLOCK:
        tree.__init__(*tree.leaves())
    return new, recoded


def slices(batches, rows: int = 128):
    """Record batches cut to a few rows, as a tree is larger than its text."""
    for b in batches:
        for k in range(0, b.num_rows, rows):
            yield b.slice(k, rows)


def build(docs: DataFrame, path: str = TOKENIZER) -> DataFrame:
    """``doc_id, text, tree, n_pretokens, n_tokens`` for each row of ``docs``:
    the stored form of the tree, and its sums. A null text counts as empty
    and keeps being null. ``path`` is a vocabulary file that every executor
    can read. Other columns are ignored; repeated rows each give a row."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        tok = tokenizer(path)
        for b in slices(batches):
            trees = [build_tree(t.as_py(), tok) for t in b.column("text")]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("text"), pa.array([t.to_bytes() for t in trees], pa.binary()),
                 pa.array([sum(len(x[0]) for x in t.blocks) for t in trees], pa.int64()),
                 pa.array([t.total() for t in trees], pa.int64())], ["doc_id", "text", "tree", "n_pretokens", "n_tokens"])

    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, text string, tree binary, n_pretokens long, n_tokens long")


APPLIED = "text string, tree binary, n_edits long, n_tokens_before long, n_tokens long, n_pretokens long, n_recoded long"


def apply(trees: DataFrame, path: str = TOKENIZER) -> DataFrame:
    """The rows of ``trees(doc_id, text, tree, edits)`` after their edits
    (arrays of ``start, end, replacement``, in code points of the text before
    any of them; null is none; see ``checked``), with the counts before and
    after and the number of pre-tokens encoded again. A null text stays."""
    kind = trees.schema["doc_id"].dataType.simpleString()

    def run(batches):
        tok = tokenizer(path)
        for b in slices(batches):
            rows = []
            for text, data, edits in zip(b.column("text"), b.column("tree"), b.column("edits").to_pylist()):
                t, tree = text.as_py(), TokenTree.from_bytes(data.as_py())
                todo = checked([(e["start"], e["end"], e["replacement"]) for e in edits or []], len(t or ""))
                before, recoded = tree.total(), 0
                stored = data.as_py()
                if todo and t is not None:
                    t, recoded = apply_edits(tree, t, todo, tok)
                    stored = tree.to_bytes()
                rows.append((t, stored, len(todo) if t is not None else 0, before, tree.total(),
                             sum(len(x[0]) for x in tree.blocks), recoded))
            cols = list(zip(*rows)) or [()] * 7
            kinds = [pa.string(), pa.binary()] + [pa.int64()] * 5
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *(pa.array(c, k) for c, k in zip(cols, kinds))],
                                             ["doc_id", *(x.split()[0] for x in APPLIED.split(", "))])

    return trees.select("doc_id", "text", "tree", "edits").mapInArrow(run, f"doc_id {kind}, {APPLIED}")


BLANKS = regex.compile(r"[ \t]{2,}")


def cleaning_edits(text: str | None) -> list[tuple[int, int, str]]:
    """Edits of a cleaning step: personal data by its kind in brackets, runs
    of blanks by one."""
    found = [(a, b, f"[{k.upper()}]") for k, a, b in pii.base_spans(text)]
    return checked(found + [(*m.span(), " ") for m in BLANKS.finditer(text or "")], len(text or ""))


def edited_counts(docs: DataFrame, path: str = TOKENIZER, edits=cleaning_edits) -> DataFrame:
    """Counts of every document before and after the edits that a function of
    its text gives: ``doc_id, n_tokens, n_edits, n_tokens_after, n_pretokens``
    (after) and ``n_recoded``. One tree is held at a time."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = ["n_tokens", "n_edits", "n_tokens_after", "n_pretokens", "n_recoded"]

    def run(batches):
        tok = tokenizer(path)
        for b in batches:
            rows = []
            for t in b.column("text"):
                text = t.as_py()
                tree, todo, recoded = build_tree(text, tok), edits(text), 0
                before = tree.total()
                if todo:
                    _, recoded = apply_edits(tree, text, todo, tok)
                rows.append((before, len(todo), tree.total(), sum(len(x[0]) for x in tree.blocks), recoded))
            cols = list(zip(*rows)) or [()] * 5
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *(pa.array(c, pa.int64()) for c in cols)], ["doc_id", *names])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, " + ", ".join(f"{n} long" for n in names))
