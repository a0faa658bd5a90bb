"""Text to ids and back. Narrow Arrow expressions: no shuffle, no explode to one row per token."""

from __future__ import annotations

import heapq
import sys

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import fixed
from ..functions.arrays import IDS_RUN, TEXT_RUN, in_parts
from ..schemas import IDS
from .merges import WIDTH, Words, at_once, numbered, numbers_of, symbols_of
from .vocab import collect_pieces, prepared, split_pretokens


#: Bytes, roughly, that a worker remembers of pre-tokens and their ids.
MEMORY = 64_000_000
#: Passes over the new pre-tokens of a run that their merges may take together; beyond, each is merged for itself.
PASSES = 64


def _regroup(words: pa.Array, per_word: np.ndarray, flat: pa.Array) -> pa.Array:
    """Ids per document from ids per word: the document bounds moved from words to ids."""
    ends = np.concatenate([[0], np.cumsum(per_word)])
    bounds = words.offsets.to_numpy()
    return pa.ListArray.from_arrays(pa.array(ends[bounds - bounds[0]].astype(np.int32)), flat)


def encode_words(text: Column, vocab: DataFrame, drop_unknown: bool = True) -> Column:
    """Word ids of a text: one hash lookup per word, in Arrow. Unknown words are id 0."""
    pieces = collect_pieces(vocab)
    specials = [p for p in fixed.WORD_SPECIALS if p in pieces[: len(fixed.WORD_SPECIALS)]]

    @F.arrow_udf(IDS)
    @in_parts(4 * TEXT_RUN)
    def lookup(texts: pa.Array) -> pa.Array:
        words = split_pretokens(texts, "word")
        flat = words.flatten()
        ids = pc.fill_null(pc.index_in(flat, value_set=pa.array(pieces, pa.string())), fixed.UNK_ID)
        keep = pc.not_equal(flat, "")
        if drop_unknown:
            keep = pc.and_(keep, pc.not_equal(ids, fixed.UNK_ID))
        return _regroup(words, keep.to_numpy(zero_copy_only=False).astype(np.int64), ids.filter(keep))

    return lookup(prepared(text, "word", specials[1:]))


def merge_symbols(symbols: list[str], ranks: dict[tuple[str, str], int]) -> list[str]:
    """Apply merges to one pre-token, lowest rank first, left to right."""
    after = list(range(1, len(symbols) + 1))
    before = list(range(-1, len(symbols) - 1))
    parts: list[str | None] = list(symbols)
    heap = [(ranks[p], i, *p) for i, p in enumerate(zip(symbols, symbols[1:])) if p in ranks]
    heapq.heapify(heap)
    while heap:
        _, i, left, right = heapq.heappop(heap)
        j = after[i]
        if parts[i] != left or j >= len(parts) or parts[j] != right:
            continue
        parts[i], parts[j] = left + right, None
        after[i] = after[j]
        if after[j] < len(parts):
            before[after[j]] = i
        for a, b in ((before[i], i), (i, after[i])):
            if a >= 0 and b < len(parts) and (parts[a], parts[b]) in ranks:
                heapq.heappush(heap, (ranks[parts[a], parts[b]], a, parts[a], parts[b]))
    return [p for p in parts if p is not None]


def encode_bpe(text: Column, merges: DataFrame, vocab: DataFrame, pretok: str = "word") -> Column:
    """Piece ids of a text; newlines give no token, special strings their own id.

    Layouts: ``word`` keeps words and one space between them, ``line`` every byte of a line after NFC, ``text`` every
    character (a line break reads as a space). Each distinct pre-token of a batch is merged once per worker and
    remembered; documents are then put together by Arrow. A character without a piece becomes its UTF-8 byte pieces,
    and so does in the text layout what only looks like a word mark, a special or a byte piece.
    """
    pieces = collect_pieces(vocab)
    pairs = merges.orderBy("rank").limit(fixed.MAX_VOCAB + 1).collect()
    if len(pairs) > fixed.MAX_VOCAB:
        raise ValueError("more merges than 16-bit ids; at most 65,536")
    specials = fixed.LINE_SPECIALS if pretok == "line" else fixed.WORD_SPECIALS
    id_of = {p: i for i, p in enumerate(pieces)}
    ranks = {(r.left, r.right): r.rank for r in reversed(pairs) if r.left + r.right in id_of}
    special_ids = {s: id_of[s] for s in specials}
    reserved = {*specials, *(f"<0x{b:02X}>" for b in range(256))} if pretok == "text" else set()
    apart = [s for s in specials if special_ids[s]]
    unit = 2 if pretok == "line" else 1
    merged_pieces = {a + b for a, b in ranks}
    id_table: np.ndarray | None = None
    known: dict[str, bytes] = {}
    held = 0
    # Merges in rank order are the lowest rank first, unless a piece is spelt again after a merge that needs it.
    steps, number_of = numbered([p for p, _ in sorted(ranks.items(), key=lambda x: x[1])], pretok)
    groups = at_once(steps)
    first = {s: k for k, s in reversed(list(enumerate(x for *_, x in steps)))}
    in_order = all(first.get(x, -1) < k for k, (l, r, _) in enumerate(steps) for x in (l, r)) and len(first) == len(steps)
    together = in_order and len(groups) <= PASSES
    id_by_number = {number_of(p): i for p, i in id_of.items() if p not in reserved and (len(p) == unit or p in merged_pieces)}

    def bytes_of(piece: str) -> list[int]:
        return [id_of[f"<0x{b:02X}>"] for b in piece.encode()]

    def alone(word: str) -> list[int]:
        if word in special_ids:
            return [special_ids[word]] if special_ids[word] else bytes_of(word) if pretok == "text" else []
        merged = merge_symbols(symbols_of(word, pretok), ranks)
        if pretok == "line":
            return [id_of[p] for p in merged]
        if pretok == "text" and word == fixed.WORD_MARK:
            return bytes_of(word)
        ids = []
        for piece in merged:
            found = None if piece in reserved else id_of.get(piece)
            ids += bytes_of(piece.replace(fixed.WORD_MARK, " ") if pretok == "text" else piece) if found is None else [found]
        return ids

    def learn(new: list[str], table: np.ndarray) -> None:
        """Make these words known, together as far as their pieces all have ids."""
        rest = new
        if together:
            plain = [w for w in new if w not in special_ids and w != fixed.WORD_MARK]
            syms = [numbers_of(w, pretok) for w in plain]
            lengths = np.array([len(s) // 4 for s in syms], np.int64)
            words = Words(np.frombuffer(b"".join(syms), "<i4"), lengths, np.arange(len(plain), dtype="i4"))
            for group in groups:
                words.apply(group)
            coded = table[words.syms]
            ends = np.flatnonzero(words.syms < 0)
            bad = np.unique(words.n[(coded < 0) & (words.syms >= 0)])
            raw, starts = coded.astype("<i4").tobytes(), np.concatenate([[0], ends[:-1] + 1])
            known.update((w, raw[4 * a : 4 * b]) for w, a, b in zip(plain, starts.tolist(), ends.tolist()))
            rest = [w for w in new if w in special_ids or w == fixed.WORD_MARK] + [plain[i] for i in bad.tolist()]
        known.update((w, np.array(alone(w), "<i4").tobytes()) for w in rest)

    @F.arrow_udf(IDS)
    @in_parts(TEXT_RUN)
    def encode(texts: pa.Array) -> pa.Array:
        nonlocal held, id_table
        if id_table is None:
            id_table = np.full(1 << WIDTH, -1, "i4")
            id_table[list(id_by_number)] = list(id_by_number.values())
        words = split_pretokens(texts, pretok, apart)
        coded = words.flatten().dictionary_encode()
        types = coded.dictionary.to_pylist()
        known[""] = b""
        new = [w for w in types if w not in known]
        if new:
            learn(new, id_table)
        codes = [known[w] for w in types]
        held += sum(sys.getsizeof(w) + len(known[w]) + 140 for w in new)
        if held > MEMORY:
            known.clear()
            held = 0
        ends = np.concatenate([[0], np.cumsum([len(c) // 4 for c in codes])]).astype("i4")
        lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(codes), "<i4")))
        per_word = lists.take(coded.indices)
        return _regroup(words, pc.list_value_length(per_word).to_numpy(zero_copy_only=False), per_word.flatten())

    return encode(prepared(text, pretok, specials))


def decode_words(ids: Column, vocab: DataFrame, skip_special: bool = False) -> Column:
    """Words joined by single spaces."""
    pieces = collect_pieces(vocab)
    hidden = [p for p in fixed.WORD_SPECIALS if p in pieces[: len(fixed.WORD_SPECIALS)]] if skip_special else []

    @F.arrow_udf(T.StringType())
    @in_parts(IDS_RUN)
    def decode(rows: pa.Array) -> pa.Array:
        flat = pa.array(pieces, pa.string()).take(rows.flatten())
        keep = pc.invert(pc.is_in(flat, value_set=pa.array(hidden, pa.string())))
        listed = _regroup(rows, keep.to_numpy(zero_copy_only=False).astype(np.int64), flat.filter(keep))
        return pc.binary_join(listed, " ")

    return decode(F.coalesce(ids, F.array().cast("array<int>")))


def decode_bpe(ids: Column, vocab: DataFrame, pretok: str = "word", skip_special: bool = False) -> Column:
    """Pieces joined to text; word marks become spaces, byte pieces their bytes."""
    pieces = collect_pieces(vocab)
    specials = set(fixed.LINE_SPECIALS if pretok == "line" else fixed.WORD_SPECIALS)

    def as_bytes(piece: str) -> bytes:
        if piece in specials:
            return b"" if skip_special else piece.encode()
        if pretok == "line":
            return bytes.fromhex(piece)
        if len(piece) == 6 and piece.startswith("<0x"):
            return bytes([int(piece[3:5], 16)])
        return piece.replace(fixed.WORD_MARK, " ").encode()

    spelt = [as_bytes(p) for p in pieces]

    @F.arrow_udf(T.BinaryType())
    @in_parts(IDS_RUN)
    def decode(rows: pa.Array) -> pa.Array:
        flat = pa.array(spelt, pa.binary()).take(rows.flatten())
        listed = _regroup(rows, np.ones(len(flat), np.int64), flat)
        return pc.binary_join(listed, pa.scalar(b"", pa.binary()))

    text = F.decode(decode(F.coalesce(ids, F.array().cast("array<int>"))), "UTF-8")
    # The mark before the first word stands for the start of the text, not for a space.
    return text if pretok == "line" else F.regexp_replace(text, "^ ", "")
