"""Alignment of two tokenizers: which tokens of one cover which tokens of the other, by byte offsets.

Tokenizer A is a byte-level BPE (a ``tokenizers`` file) and reads a space and the text, tokenizer B a SentencePiece BPE with byte
fallback, which adds that space itself. ``pandas.merge_asof`` finds for each start of an A token the B token that covers it, and the other
way round; the union of both are the overlaps. Where an A and a B token end at the same byte, a group ends; all A and B tokens of a
group are linked.

Both tokenizers and so all groups break where a space or a line feed follows something that is no white space: A's pattern takes
white space with what follows it, and no piece of B has a space after another character or a line feed at all (checked when the file is read).
A text is cut there, and each different piece that a task meets is one document of a merge: tokenized, merged and grouped once.
``pieces_of`` states the cut; tests compare with whole texts.

Counts of id pairs: how many documents hold a pair linked. 1. A scan writes the pairs of each document as sorted numbers (4 bytes
each, as differences). 2. They are counted inside tasks and summed by hash range. 3. A second pass adds up the counts of each
document's links. The at most ``head_pairs`` most frequent pairs (12 bytes each) and the highest count of each A id (at most A's vocabulary)
are broadcast; the links of other pairs are joined with the written counts. Joined pairs are rarer than all broadcast ones.

Scale: no text is shuffled; only packed counts are, and the rare pairs. A task holds ``GROUP_BYTES`` of text or its longest text,
and at most about ``KNOWN_PIECES`` pieces.

Defined cases: a text that is null, empty or not restored by the tokens of A or of B (for B: one that holds U+2581) has no
tokens, groups or links; so has one that is no valid UTF-8. Repeated rows are aligned and counted one by one; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import os
import re
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from inkprint.llm.common import lists, query, table, texts_of, with_struct
from inkprint.session import materialize, scratch_path

GROUP_BYTES = 2 << 20
KNOWN_PIECES = 400_000
FLUSH_PAIRS = 8 << 20
_SPACE = "▁"  # how B writes a space
_CUT = re.compile(r"(?<=\S)(?=[ \n])")
_ODD = re.compile(r"\s[ \n]|^[ \n]")
_LEVEL = 4  # levels of a doubling, for the head's cut


@dataclass(frozen=True)
class Tokenizers:
    """Paths that every executor can read."""

    byte_bpe: str = "/opt/tokenizers/byte_bpe_50k.json"
    piece_bpe: str = "/opt/tokenizers/piece_bpe_32k.model"


def pieces_of(text: str) -> list[str]:
    """The pieces of space + text, each without its first space, but for those in which a line feed comes before all but spaces."""
    if not _ODD.search(text):
        return text.replace("\n", " \n").split(" ")
    return [p if p.lstrip(" ")[:1] == "\n" else p[1:] for p in _CUT.split(" " + text)]


def _whole(piece: str) -> str:
    """The characters of a piece."""
    return piece if piece.lstrip(" ")[:1] == "\n" else " " + piece


def overlaps(a: pd.DataFrame, b: pd.DataFrame) -> np.ndarray:
    """Pairs (row of a, row of b) of tokens that share bytes; both have doc and at (their first byte), ordered by at, where documents
    lie one after another and tokens have no gaps. A column per pair, ordered."""
    one = pd.merge_asof(a.assign(a=np.arange(len(a))), b.assign(b=np.arange(len(b))), on="at", by="doc")
    two = pd.merge_asof(b.assign(b=np.arange(len(b))), a.assign(a=np.arange(len(a))), on="at", by="doc")
    both = pd.concat([one[["a", "b"]], two[["a", "b"]]]).dropna().to_numpy(np.int64)
    pairs = np.unique(both[:, 0] * max(1, len(b)) + both[:, 1])
    return np.stack([pairs // max(1, len(b)), pairs % max(1, len(b))])


def _ragged(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """start[i], start[i] + 1, ... (size[i] numbers) for all i."""
    ends = np.cumsum(size)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - size - start, size)


class _Flat:
    """A growing array of runs."""

    def __init__(self):
        self.data, self.used = np.zeros(1024, dtype=np.int32), 0  # ids, places, and pairs below 2^31
        self.start, self.size = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)

    def add(self, values: np.ndarray, sizes: np.ndarray):
        need = self.used + len(values)
        if need > len(self.data):
            self.data = np.concatenate([self.data[:self.used], np.zeros(max(need, len(self.data)), dtype=np.int32)])
        self.data[self.used:need] = values
        self.start = np.concatenate([self.start, self.used + np.cumsum(sizes) - sizes])
        self.size = np.concatenate([self.size, sizes])
        self.used = need

    def runs(self, which: np.ndarray) -> np.ndarray:
        return self.data[_ragged(self.start[which], self.size[which])]


class Aligner:
    """Both tokenizers, and the pieces met so far, aligned."""

    def __init__(self, files: Tokenizers):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import sentencepiece
        from tokenizers import Tokenizer
        self.a = Tokenizer.from_file(files.byte_bpe)
        self.a.encode_special_tokens = True  # their strings are plain text
        self.b = sentencepiece.SentencePieceProcessor(model_file=files.piece_bpe)
        shown = _shown_bytes()
        self.a_bytes = [b""] * self.a.get_vocab_size()
        for token, k in self.a.get_vocab().items():
            self.a_bytes[k] = bytes(shown[c] for c in token) if all(c in shown for c in token) else token.encode()
        names = [self.b.id_to_piece(k) for k in range(self.b.get_piece_size())]
        if any(_SPACE in p.lstrip(_SPACE) for p in names):
            raise ValueError("a piece of the second tokenizer crosses words")
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(k) else p.replace(_SPACE, " ").encode() for k, p in enumerate(names)]
        if any("\n" in p for p in names):
            raise ValueError("a piece of the second tokenizer holds a line feed")
        self.b_size, self.b_space, self.b_unknown = len(names), self.b.piece_to_id(_SPACE), self.b.unk_id()
        self.a_names, self.b_names = (np.array(list(map(str, range(n))), dtype=object) for n in (len(self.a_bytes), len(names)))
        self.a_length = np.array([len(x) for x in self.a_bytes], dtype=np.int64)
        self.b_length = np.array([len(x) for x in self.b_bytes], dtype=np.int64)
        self.clear()

    def clear(self):
        self.code: dict[str, int] = {}
        self.text: list[str] = []  # of the groups of each piece
        self.bad = np.zeros(0, dtype=bool)
        self.tokens_a, self.tokens_b, self.links = _Flat(), _Flat(), _Flat()
        self.overlap_a, self.overlap_b = _Flat(), _Flat()  # places in the piece
        self.ends_a, self.ends_b = _Flat(), _Flat()  # of groups: tokens of the piece up to there

    def learn(self, texts: list[str]) -> list[list[int]]:
        """The numbers of the pieces of each text; they hold until the next call."""
        if len(self.code) > KNOWN_PIECES:
            self.clear()
        found = [pieces_of(t) if t else [] for t in texts]
        new = list(set(chain.from_iterable(found)).difference(self.code))
        new.sort()
        for at in range(0, len(new), 1 << 15):
            self._learn(new[at:at + (1 << 15)])
        return [list(map(self.code.__getitem__, x)) for x in found]

    def _tokenize_b(self, new: list[str]) -> list[list[int]]:
        """B puts a space before what it reads: that of the piece, or one that is dropped before a line feed."""
        out = self.b.encode([p[1:] if p[:1] == " " and p.lstrip(" ")[:1] == "\n" else p for p in new], num_threads=1)
        for k, p in enumerate(new):
            if p[:1] == "\n":
                out[k] = out[k][1:] if out[k][:1] == [self.b_space] else [self.b_unknown]
            elif not p:
                out[k] = [self.b_space]
        return out

    def _learn(self, new: list[str]):
        self.code.update(zip(new, range(len(self.code), len(self.code) + len(new))))
        whole = [_whole(p) for p in new]
        ids_a = [e.ids for e in self.a.encode_batch_fast(whole, add_special_tokens=False)]
        ids_b = self._tokenize_b(new)
        whole = [w.encode() for w in whole]
        sizes = np.array([len(w) for w in whole], dtype=np.int64)
        bad = np.zeros(len(new), dtype=bool)
        for ids, known, length in ((ids_a, self.a_bytes, self.a_length), (ids_b, self.b_bytes, self.b_length)):
            flat = np.fromiter(chain.from_iterable(ids), np.int64, sum(map(len, ids)))
            piece = np.repeat(np.arange(len(new)), list(map(len, ids)))
            same = np.bincount(piece, weights=length[flat], minlength=len(new)) == sizes
            if not same.all() or b"".join(map(known.__getitem__, flat.tolist())) != b"".join(whole):
                bad |= np.array([b"".join(map(known.__getitem__, x)) != w for x, w in zip(ids, whole)])
        self.bad = np.concatenate([self.bad, bad])
        base = np.cumsum(sizes) - sizes  # pieces lie one after another

        def side(ids, length, known: _Flat):
            ids = [[] if x else i for i, x in zip(ids, bad.tolist())]
            n = np.array(list(map(len, ids)), dtype=np.int64)
            flat = np.fromiter(chain.from_iterable(ids), np.int64, int(n.sum()))
            known.add(flat, n)
            piece = np.repeat(np.arange(len(new)), n)
            width = length[flat]
            first = np.cumsum(n) - n
            done = np.cumsum(width)
            end = done - np.repeat((done - width)[np.minimum(first, max(0, len(done) - 1))], n) + base[piece] if len(flat) else done
            return flat, n, first, piece, end - width, end

        a, n_a, first_a, piece_a, start_a, end_a = side(ids_a, self.a_length, self.tokens_a)
        b, n_b, first_b, piece_b, start_b, end_b = side(ids_b, self.b_length, self.tokens_b)
        shared = overlaps(pd.DataFrame({"doc": piece_a, "at": start_a}), pd.DataFrame({"doc": piece_b, "at": start_b}))
        n_shared = np.bincount(piece_a[shared[0]], minlength=len(new))
        self.overlap_a.add(shared[0] - first_a[piece_a[shared[0]]], n_shared)
        self.overlap_b.add(shared[1] - first_b[piece_b[shared[1]]], n_shared)

        common = np.intersect1d(end_a, end_b, assume_unique=True)
        last_a, last_b = np.searchsorted(end_a, common, side="right"), np.searchsorted(end_b, common, side="right")
        of = piece_a[last_a - 1]
        groups = np.bincount(of, minlength=len(new))
        self.ends_a.add(last_a - first_a[of], groups)
        self.ends_b.add(last_b - first_b[of], groups)
        in_a, in_b = np.diff(last_a, prepend=0), np.diff(last_b, prepend=0)
        left = np.repeat(a, np.repeat(in_b, in_a))
        right = b[_ragged(np.repeat(last_b - in_b, in_a), np.repeat(in_b, in_a))]
        self.links.add(left * self.b_size + right, np.bincount(of, weights=in_a * in_b, minlength=len(new)).astype(np.int64))
        # the groups as text: ids and marks in turn, those of A before those of B in each group
        at_a, at_b = np.arange(len(a)) + np.repeat(last_b - in_b, in_a), np.arange(len(b)) + np.repeat(last_a, in_b)
        marks = np.empty(2 * (len(a) + len(b)), dtype=object)
        for at, ids, names, last, mark in ((at_a, a, self.a_names, last_a, "|"), (at_b, b, self.b_names, last_b, ";")):
            marks[2 * at], marks[2 * at + 1] = names[ids], ","
            marks[2 * at[last - 1] + 1] = mark
        marks, ends = marks.tolist(), np.cumsum(2 * (n_a + n_b)).tolist()
        self.text += ["".join(marks[p:q - 1]) for p, q in zip([0, *ends], ends)]


def _shown_bytes() -> dict[str, int]:
    """The character by which a byte-level vocabulary shows a byte: itself where it is printable, else the next free one from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [c for c in range(256) if c not in plain]
    return {chr(c): c for c in plain} | {chr(256 + k): c for k, c in enumerate(rest)}


def _decoded(texts: list[bytes | None]) -> list[str]:
    """Texts as strings; '' for those without tokens from the start."""
    out = []
    for t in texts:
        try:
            out.append(t.decode() if t else "")
        except UnicodeDecodeError:
            out.append("")
    return out


def _blocks(texts: list[str]):
    """(from, to) of consecutive texts of bounded size."""
    start, held = 0, 0
    for k, t in enumerate(texts):
        held += len(t)
        if held >= GROUP_BYTES:
            yield start, k + 1
            start, held = k + 1, 0
    if start < len(texts):
        yield start, len(texts)


_INT = T.IntegerType()
_ALIGNED = T.StructType([
    T.StructField("a", T.ArrayType(_INT)), T.StructField("b", T.ArrayType(_INT)),
    T.StructField("overlaps", T.ArrayType(T.StructType([T.StructField("a", _INT), T.StructField("b", _INT)]))),
    T.StructField("groups", T.ArrayType(T.StructType([T.StructField("a_end", _INT), T.StructField("b_end", _INT)])))])


def align(docs: DataFrame, files: Tokenizers = Tokenizers(), text: str = "text", into: str = "alignment") -> DataFrame:
    """Every row of ``docs`` with a struct ``into``: the ids a and b, overlaps (places of an A and a B token that share bytes), and groups
    (how many tokens of either side lie before each group's end)."""
    def start():
        aligner = Aligner(files)

        def compute(texts):
            rows = [([], [], [], [])] * len(texts)
            texts = _decoded(texts)
            for p, q in _blocks(texts):
                for k, mine in zip(range(p, q), aligner.learn(texts[p:q])):
                    codes = np.array(mine, dtype=np.int64)
                    if not len(codes) or aligner.bad[codes].any():
                        continue

                    def shifted(flat: _Flat, tokens: _Flat):
                        before = np.cumsum(tokens.size[codes]) - tokens.size[codes]  # noqa: B023
                        return flat.runs(codes) + np.repeat(before, flat.size[codes])  # noqa: B023

                    x = aligner
                    rows[k] = (x.tokens_a.runs(codes).tolist(), x.tokens_b.runs(codes).tolist(),
                               [{"a": i, "b": j} for i, j in zip(shifted(x.overlap_a, x.tokens_a).tolist(), shifted(x.overlap_b, x.tokens_b).tolist())],
                               [{"a_end": i, "b_end": j} for i, j in zip(shifted(x.ends_a, x.tokens_a).tolist(), shifted(x.ends_b, x.tokens_b).tolist())])
            kinds = [pa.list_(pa.int32())] * 2 + [pa.list_(pa.struct([(n, pa.int32()) for n in names])) for names in (("a", "b"), ("a_end", "b_end"))]
            return [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)]
        return compute

    return with_struct(docs, text, into, _ALIGNED, start, rows=200)


_NUMBERS = ["n_a", "n_b", "n_groups", "n_links", "n_overlaps"]
_SCANNED = T.StructType([*[T.StructField(n, T.LongType()) for n in _NUMBERS], T.StructField("groups_sha256", T.StringType()),
                         T.StructField("pairs", T.BinaryType()), T.StructField("times", T.BinaryType())])


def _packed(sorted_codes: np.ndarray) -> bytes:
    """Ascending numbers below 2^31 as differences, byte by byte, which compresses well."""
    return np.diff(sorted_codes, prepend=0).astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    return np.cumsum(np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(4, -1).T).view("<u4").ravel(), dtype=np.int64)


def _scan(files: Tokenizers):
    aligner = Aligner(files)

    def block(texts: list[str]):
        """The fields of ``_SCANNED`` but the last two, and for each text the pairs and how often each is linked."""
        codes = aligner.learn(texts)
        flat = np.fromiter(chain.from_iterable(codes), np.int64, sum(map(len, codes)))
        doc = np.repeat(np.arange(len(texts)), [len(x) for x in codes])
        bad = np.zeros(len(texts), dtype=bool)
        bad[doc[aligner.bad[flat]]] = True
        keep = ~bad[doc]
        flat, doc = flat[keep], doc[keep]

        def total(of: _Flat):
            return np.bincount(doc, weights=of.size[flat], minlength=len(texts)).astype(np.int64)

        numbers = [total(x) for x in (aligner.tokens_a, aligner.tokens_b, aligner.ends_a, aligner.links, aligner.overlap_a)]
        prints = [hashlib.sha256(";".join(map(aligner.text.__getitem__, x)).encode()).hexdigest() if x and not no else ""
                  for x, no in zip(codes, bad)]
        keys, times = np.unique(doc << 32 | flat, return_counts=True)
        doc, piece = keys >> 32, keys & 0xFFFFFFFF
        n = aligner.links.size[piece]
        keys = np.repeat(doc, n) << 32 | aligner.links.runs(piece).astype(np.int64)
        times = np.repeat(times, n)
        order = np.argsort(keys)
        keys, times = keys[order], times[order]
        first = np.flatnonzero(np.diff(keys, prepend=-1))
        times = np.add.reduceat(times, first) if len(first) else times
        keys = keys[first]
        cuts = np.searchsorted(keys >> 32, np.arange(1, len(texts)))
        return numbers, prints, np.split(keys & 0xFFFFFFFF, cuts), np.split(times, cuts)

    def compute(texts):
        texts = _decoded(texts)
        found = [block(texts[p:q]) for p, q in _blocks(texts)]
        numbers = [np.concatenate([f[0][k] for f in found]) if found else np.zeros(0, dtype=np.int64) for k in range(len(_NUMBERS))]
        return [*(pa.array(n, pa.int64()) for n in numbers), pa.array([x for f in found for x in f[1]], pa.string()),
                pa.array([_packed(x) for f in found for x in f[2]], pa.binary()),
                pa.array([x.astype(np.uint32).tobytes() for f in found for x in f[3]], pa.binary())]
    return compute


def _count_pairs(part_log: int):
    def emit(codes, counts):
        part = (codes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - part_log)).astype(np.int32)
        order = np.argsort(part, kind="stable")
        codes, counts, part = codes[order], counts[order], part[order]
        first = np.flatnonzero(np.diff(part, prepend=-1))
        last = np.append(first[1:], len(part))
        return pa.RecordBatch.from_arrays([
            pa.array(part[first]), pa.array([_packed(codes[a:b]) for a, b in zip(first, last)], pa.binary()),
            pa.array([counts[a:b].astype(np.uint32).tobytes() for a, b in zip(first, last)], pa.binary())], ["part", "codes", "n"])

    def run(batches):
        codes, counts = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        held, size = [], 0
        for batch in batches:
            for data in batch.column(0).to_pylist():
                held.append(_unpacked(data))
                size += len(held[-1])
            if size >= FLUSH_PAIRS:
                codes, counts = _summed([codes, *held], [counts, np.ones(size, dtype=np.int64)])
                held, size = [], 0
                if len(codes) >= FLUSH_PAIRS:
                    yield emit(codes, counts)
                    codes, counts = codes[:0], counts[:0]
        yield emit(*_summed([codes, *held], [counts, np.ones(size, dtype=np.int64)]))
    return run


def _summed(codes, counts):
    codes, counts = np.concatenate(codes), np.concatenate(counts)
    order = np.argsort(codes, kind="stable")
    codes, counts = codes[order], counts[order]
    first = np.flatnonzero(np.diff(codes, prepend=-1))
    return codes[first], np.add.reduceat(counts, first) if len(first) else counts


def _sum_pairs(b_size: int):
    """The counts of each part, how many have which level, and the highest of each A id."""
    def run(batches):
        parts: dict[int, list] = {}
        for batch in batches:
            for part, codes, n in zip(*(batch.column(k).to_pylist() for k in range(3))):
                parts.setdefault(part, []).append((codes, n))
        for part in list(parts):
            blocks = parts.pop(part)
            codes, n = _summed([_unpacked(c) for c, _ in blocks], [np.frombuffer(x, np.uint32).astype(np.int64) for _, x in blocks])
            ids = codes // b_size
            first = np.flatnonzero(np.diff(ids, prepend=-1))
            top = np.maximum.reduceat(n, first) if len(first) else n
            seen = np.bincount(_level(n), minlength=256)
            yield pa.RecordBatch.from_arrays([
                pa.array([part], pa.int32()), pa.array([_packed(codes)], pa.binary()), pa.array([n.astype(np.int64).tobytes()], pa.binary()),
                pa.array([seen.tolist()], pa.list_(pa.int64())), pa.array([ids[first].tolist()], pa.list_(pa.int64())),
                pa.array([top.tolist()], pa.list_(pa.int64()))], ["part", "codes", "n", "seen", "ids", "top"])
    return run


def _level(n: np.ndarray) -> np.ndarray:
    return np.floor(np.log2(np.maximum(n, 1)) * _LEVEL + 1e-9).astype(np.int64)


def _some_pairs(cut: int, above: bool):
    """(code, n) of the pairs of a level from ``cut`` on, or below."""
    def run(batches):
        for batch in batches:
            for codes, n in zip(*(batch.column(k).to_pylist() for k in range(2))):
                codes, n = _unpacked(codes), np.frombuffer(n, np.int64)
                mine = (_level(n) >= cut) == above
                yield pa.RecordBatch.from_arrays([pa.array(codes[mine], pa.int64()), pa.array(n[mine], pa.int64())], ["code", "n"])
    return run


def _add_up(shared, b_size: int, keys: list[str]):
    names = [*keys, *_NUMBERS, "groups_sha256", "n_best", "count_sum", "rest"]

    def run(batches):
        codes, counts, best = shared.value
        for batch in batches:
            pairs = [_unpacked(x) for x in batch.column("pairs").to_pylist()]
            doc = np.repeat(np.arange(batch.num_rows), [len(x) for x in pairs])
            pairs = np.concatenate([np.zeros(0, dtype=np.int64), *pairs])
            times = np.frombuffer(b"".join(batch.column("times").to_pylist()), np.uint32).astype(np.int64)
            at = np.minimum(np.searchsorted(codes, pairs), max(0, len(codes) - 1))
            known = codes[at] == pairs if len(codes) else np.zeros(len(pairs), dtype=bool)
            n = np.where(known, counts[at], 0) if len(codes) else np.zeros(len(pairs), dtype=np.int64)
            top = known & (n == best[pairs // b_size])
            order = np.concatenate([[0], np.cumsum(np.bincount(doc[~known], minlength=batch.num_rows))])
            rest = lists(order, pa.StructArray.from_arrays([pa.array(pairs[~known]), pa.array(times[~known])], ["code", "times"]))
            yield pa.RecordBatch.from_arrays([
                *(batch.column(k) for k in [*keys, *_NUMBERS, "groups_sha256"]), _sums(doc, times * top, batch.num_rows),
                _sums(doc, times * n, batch.num_rows), rest], names)
    return run


def _sums(doc: np.ndarray, values: np.ndarray, rows: int) -> pa.Array:
    """Exact sums by row; ``doc`` ascends."""
    ends = np.concatenate([[0], np.cumsum(values)])
    bounds = np.searchsorted(doc, np.arange(rows + 1))
    return pa.array(ends[bounds[1:]] - ends[bounds[:-1]], pa.int64())


def alignment_counts(docs: DataFrame, keys: list[str], files: Tokenizers = Tokenizers(), text: str = "text",
                     head_pairs: int = 2_000_000) -> DataFrame:
    """``keys`` of every row with n_a, n_b, n_groups, n_links, n_overlaps, groups_sha256, and over its links n_best (those whose pair
    is in as many documents as the A id's most frequent one) and count_sum (the documents of each link's pair)."""
    spark = docs.sparkSession
    columns = [f"__key{k}" for k in range(len(keys))]
    chosen = docs.select(*[docs[c].alias(k) for c, k in zip(keys, columns)], docs[text].cast("string").alias("__text"))
    path = scratch_path(spark, "pairs")
    scanned = with_struct(chosen, "__text", "__s", _SCANNED, lambda: _scan(files), rows=2000).select(*columns, "__s.*")
    scanned.write.option("compression", "zstd").parquet(path)
    scanned = spark.read.schema(scanned.schema).parquet(path)

    b_size = Aligner(files).b_size
    links = scanned.agg(F.sum("n_links")).first()[0] or 0
    part_log = max(3, min(16, (links >> 24).bit_length()))
    partitions = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1 << part_log)
    pairs = materialize(scanned.select("pairs").mapInArrow(_count_pairs(part_log), "part int, codes binary, n binary")
                        .repartition(partitions, "part").mapInArrow(
        _sum_pairs(b_size), "part int, codes binary, n binary, seen array<long>, ids array<long>, top array<long>"), "pair_counts")
    seen = {r["level"]: r["n"] for r in pairs.select(F.posexplode("seen").alias("level", "n")).groupBy("level").agg(F.sum("n").alias("n")).collect()}
    held, cut = 0, 256
    for level in range(255, -1, -1):
        if held + seen.get(level, 0) > head_pairs:
            break
        held, cut = held + seen.get(level, 0), level
    tops = pairs.select(F.explode(F.arrays_zip("ids", "top")).alias("t")).groupBy(F.col("t.ids").alias("id")).agg(F.max("t.top").alias("top"))
    best = np.zeros(50_000, dtype=np.int64)
    for r in tops.toLocalIterator():
        if r["id"] >= len(best):
            best = np.concatenate([best, np.zeros(r["id"] + 1, dtype=np.int64)])
        best[r["id"]] = r["top"]
    head = pairs.select("codes", "n").mapInArrow(_some_pairs(cut, True), "code long, n long").toArrow()
    codes, counts = (head.column(c).to_numpy() for c in ("code", "n"))
    order = np.argsort(codes)
    shared = spark.sparkContext.broadcast((codes[order].astype(np.int32), counts[order], best))

    fields = [f for f in scanned.schema.fields if f.name in columns]
    added = T.StructType([*fields, *[T.StructField(n, T.LongType()) for n in _NUMBERS], T.StructField("groups_sha256", T.StringType()),
                          T.StructField("n_best", T.LongType()), T.StructField("count_sum", T.LongType()),
                          T.StructField("rest", T.ArrayType(T.StructType([T.StructField("code", T.LongType()), T.StructField("times", T.LongType())])))])
    out = scanned.mapInArrow(_add_up(shared, b_size, columns), added)
    if cut > 0:  # some pairs are not in the head
        out = materialize(out.withColumn("__row", F.monotonically_increasing_id()), "added")
        tail = pairs.select("codes", "n").mapInArrow(_some_pairs(cut, False), "code long, n long")
        asked = out.select("__row", F.explode("rest").alias("x")).select("__row", "x.code", "x.times").join(tail, "code") \
            .join(tops.withColumnRenamed("id", "__id"), F.floor(F.col("code") / b_size) == F.col("__id"))
        rare = asked.groupBy("__row").agg(F.sum(F.col("times") * F.col("n")).alias("__sum"),
                                          F.sum(F.when(F.col("n") == F.col("top"), F.col("times")).otherwise(0)).alias("__best"))
        out = out.join(rare, "__row", "left").withColumn("count_sum", F.col("count_sum") + F.coalesce("__sum", F.lit(0))) \
            .withColumn("n_best", F.col("n_best") + F.coalesce("__best", F.lit(0)))
    return out.select(*[F.col(k).alias(c) for c, k in zip(keys, columns)], *_NUMBERS, "groups_sha256", "n_best", "count_sum")


@query("op11_token_alignment")
def op11(spark, d):
    return alignment_counts(table(spark, d, "documents").select("doc_id", "text"), ["doc_id"]).select(
        F.col("doc_id").cast("long").alias("doc_id"), "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "n_overlaps")
