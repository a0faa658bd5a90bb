"""Token ids of whole texts through the ``tokenizers`` library, one space-separated piece at a time.

Both vocabularies cut a text before any single space that stands between two characters which are
not white space, before they look for merges. A text therefore has the ids of its pieces laid end to
end, and a piece seen before need not be encoded again. Texts with other white space around a space
are cut only where the rule holds. They also cut around a line feed that stands alone, and between a letter or
digit and a full stop or comma, so a piece that is new may still be made of known ones.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Pieces that a worker remembers; beyond, those go that were not met again. Some 30 bytes each, ids included.
REMEMBERED = 350_000
#: Stands between pieces that are encoded together; a piece that holds it is encoded alone.
MARK = "\ue000"
TOGETHER = 64
#: A space in a byte-level vocabulary.
SPACE = "\u0120"
_CUT = re.compile(r"(?<=\S) (?=\S)")
#: Letters that no normalization changes but for their case, and that every vocabulary here keeps together.
LETTERS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff"
_WORD = re.compile(f"[{LETTERS}]+")
#: What the word vocabulary does before it looks for merges.
_WORD_RULES = (
    [("NFC", None), ("Replace", "\\s+"), ("Lowercase", None)],
    [("Split", r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"), ("ByteLevel", None)],
)


def _ends(piece: str) -> bool:
    return len(piece) > 1 and piece[-1] in ".," and piece[-2].isalnum()


def _rules(how: dict) -> tuple[list, list]:
    """Names and patterns of a vocabulary's normalizers and of its pre-tokenizers."""
    steps = (how["normalizer"] or {}).get("normalizers", []), how["pre_tokenizer"].get("pretokenizers", [])
    return tuple([(x["type"], x.get("pattern", {}).get("Regex")) for x in y] for y in steps)


class PieceEncoder:
    """Encodes texts as the library does by default: special tokens' strings inside a text are their ids.

    They hold no white space, so they lie whole in one piece, and what follows one starts anew as a piece does.
    A word of ``LETTERS`` is one unit of merges, which the library's model takes as it is.

    path  file of the tokenizer; its ids must fit 16 bits
    """

    def __init__(self, path: str, remembered: int = REMEMBERED):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.model = Tokenizer.from_file(path)
        if self.model.get_vocab_size() > 65_536:
            raise ValueError("the vocabulary does not fit 16 bits")
        self.remembered = remembered
        # The mark's own bytes in front of a space: no id of a neighbour can take part in them.
        self.mark = np.array(self.model.encode(f" {MARK}", add_special_tokens=False).ids, dtype="<u2").tobytes()
        # Where a space stays in the ids, as the first byte of a piece and nowhere else in it, pieces need no mark.
        how = json.loads(self.model.to_str())
        kept = how["normalizer"] is None and how["pre_tokenizer"]["type"] == "ByteLevel" and how["pre_tokenizer"]["use_regex"]
        self.opens = np.zeros(65_536, bool) if kept else None
        if kept:
            self.opens[[i for token, i in self.model.get_vocab(with_added_tokens=False).items() if token[0] == SPACE]] = True
        self.lowers = _rules(how) == _WORD_RULES
        self.merge = self.model.model.tokenize if kept or self.lowers else None
        spell = ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        self.spelt = {c: spell(chr(c))[0][0] for c in range(0xC0, 0x100)}
        self.first: dict[str, bytes] = {}
        # Remembered pieces, where their ids begin, all their ids, and whether they were met again.
        self.names, self.ends = pa.array([], pa.string()), np.zeros(1, "i4")
        self.ids, self.again = np.zeros(0, "<u2"), np.zeros(0, bool)

    def encode(self, texts: pa.Array | Sequence[str | None]) -> list[np.ndarray]:
        """Ids of each text as unsigned 16-bit arrays; null counts as empty."""
        column = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())
        if len(self.names) > self.remembered:
            self._forget()
        if len(self.first) > self.remembered // 4:
            self.first = {}
        # Each different piece of the texts is looked up once; Arrow lays the ids end to end.
        cut = pc.split_pattern(pc.fill_null(column, ""), " ")
        flat = cut.flatten().dictionary_encode()
        types, at = flat.dictionary.cast(pa.string()), flat.indices.to_numpy().astype("i8")
        bounds = np.concatenate([[0], np.cumsum(pc.list_value_length(cut).to_numpy())])
        starts = bounds[:-1]
        inner = np.ones(len(at), bool)
        inner[starts] = False
        used = np.zeros(len(types), bool)
        used[at[inner]] = True
        heads = types.take(pa.array(at[starts])).to_pylist()
        # Of a word with a full stop or comma the word alone may be known, which the same look-up tells.
        closed = np.flatnonzero(pc.or_(pc.ends_with(types, "."), pc.ends_with(types, ",")).to_numpy(zero_copy_only=False))
        bare = pc.utf8_rtrim(types.take(pa.array(closed)), characters=".,")
        place = self._places(pa.concat_arrays([types, bare]))
        place, inside = place[: len(types)], place[len(types) :]
        missing = np.flatnonzero(used & (place < 0))
        helpful = used[closed] & (place[closed] < 0) & (inside >= 0)
        new = types.take(pa.array(missing)).to_pylist()
        parts: dict[int, list[str]] = {}
        # White space at an end never is remembered, so only new pieces may have some.
        unsafe = np.fromiter((not p or p.strip() != p for p in new), bool, len(new))
        odd = {i for i, head in enumerate(heads) if head != head.strip()}
        if odd or unsafe.any():
            # Other white space stands next to a space: these texts are cut by the rule itself.
            bad = np.zeros(len(types), bool)
            bad[missing[unsafe]] = True
            odd.update(np.unique(np.searchsorted(bounds, np.flatnonzero(bad[at] & inner), "right") - 1).tolist())
            new = [p for p, is_unsafe in zip(new, unsafe.tolist()) if not is_unsafe]
            missing = missing[~unsafe]
            for i in odd:
                heads[i], *parts[i] = _CUT.split(column[i].as_py())
        before, first = len(self.names), self.first
        asked = {p for x in parts.values() for p in x}.difference(new)
        known = self._remembered(bare.filter(pa.array(helpful)), inside[helpful])
        if asked:
            names = pa.array(list(asked), pa.string())
            known.update(self._remembered(names, self._places(names)))
        asked.difference_update(known)
        known = self._code_all({h for h in heads if h not in first}, asked.union(new), known)
        more = [p for p in asked if p and p.strip() == p]
        met = place[used]
        self.again[met[met >= 0]] = True
        place[missing] = before + np.arange(len(missing))
        new += more
        codes = [known[p] for p in new]
        kept = len(codes)
        codes += [first[h] + b"".join([known[p] for p in parts.get(i, ())]) for i, h in enumerate(heads)]
        codes.append(b"")
        at = place[at]
        at[starts] = before + kept + np.arange(len(heads))
        for i in odd:
            at[bounds[i] + 1 : bounds[i + 1]] = before + len(codes) - 1
        ends = self.ends[-1] + np.cumsum(np.fromiter(map(len, codes), "i8", len(codes)) // 2)
        ends = np.concatenate([self.ends, ends.astype("i4")])
        values = np.concatenate([self.ids, np.frombuffer(b"".join(codes), "<u2")])
        ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(values)).take(pa.array(at)).flatten().to_numpy()
        where = np.concatenate([[0], np.cumsum(np.diff(ends)[at])])[bounds].tolist()
        self.names = pa.concat_arrays([self.names, pa.array(new, pa.string())])
        self.ends, self.ids = ends[: before + kept + 1].copy(), values[: ends[before + kept]].copy()
        self.again = np.concatenate([self.again, np.zeros(kept, bool)])
        return [ids[a:b] for a, b in zip(where[:-1], where[1:])]

    def _places(self, pieces: pa.Array) -> np.ndarray:
        """Where these pieces are remembered, or -1."""
        return pc.fill_null(pc.index_in(pieces, value_set=self.names), -1).to_numpy().astype("i8")

    def _forget(self) -> None:
        """Keep what was met again, of that the half that came last."""
        keep = pa.array(np.flatnonzero(self.again)[-(self.remembered // 2) :])
        lists = pa.ListArray.from_arrays(pa.array(self.ends), pa.array(self.ids)).take(keep)
        self.names, self.ids = self.names.take(keep), lists.flatten().to_numpy()
        self.ends = np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy())]).astype("i4")
        self.again = np.zeros(len(keep), bool)

    def _code_all(self, heads: set[str], new: set[str], known: dict[str, bytes]) -> dict[str, bytes]:
        """Make all heads known; codes of the new pieces and of what they are made of, besides those that are known."""
        first = self.first
        lines, ended = self._made_of_others(new)
        lone = new.difference(lines, ended)
        for left, _ in lines.values():
            if _ends(left):
                ended.append(left)
                left = left[:-1]
            lone.add(left)
        lone.update([p[:-1] for p in ended])
        heads = heads.union((right for _, right in lines.values()), (".", ",", "\n")).difference(first)
        first.update(self._learn(heads, ""))
        known |= self._learn(lone.difference(known), " ")
        for p in ended:
            known[p] = known[p[:-1]] + first[p[-1]]
        feed = first["\n"]
        for p, (left, right) in lines.items():
            known[p] = known[left] + feed + first[right]
        return known

    def _remembered(self, pieces: pa.Array, place: np.ndarray) -> dict[str, bytes]:
        """Codes of those of these pieces that have a place."""
        found = place >= 0
        names, place = pieces.filter(pa.array(found)).to_pylist(), place[found]
        self.again[place] = True
        raw = self.ids.tobytes()
        return {p: raw[2 * a : 2 * b] for p, a, b in zip(names, self.ends[place].tolist(), self.ends[place + 1].tolist())}

    @staticmethod
    def _made_of_others(new: set[str]) -> tuple[dict[str, tuple[str, str]], list[str]]:
        """Pieces that are two parts around a line feed, and pieces that are a word and its full stop or comma."""
        lines, ended = {}, []
        for p in new:
            if "\n" in p:
                left, _, right = p.partition("\n")
                if left and right and "\n" not in right and not left[-1].isspace() and not right[0].isspace():
                    lines[p] = (left, right)
            elif p[-1:] in (".", ",") and p[-2:-1].isalnum():
                ended.append(p)
        return lines, ended

    def _learn(self, new: set[str], before: str) -> dict[str, bytes]:
        """Codes of pieces that are not made of others."""
        words, ids, ends, rest = [], [], [0], []
        if self.merge is None:
            rest = list(new)
        else:
            opening = SPACE if before and not self.lowers else ""
            merge, lowers, spelt, is_word = self.merge, self.lowers, self.spelt, _WORD.fullmatch
            for p in new:
                plain = p.isascii()
                if not (p.isalpha() if plain else is_word(p)):
                    rest.append(p)
                    continue
                word = p.lower() if lowers else p
                ids += [token.id for token in merge(opening + (word if plain else word.translate(spelt)))]
                ends.append(len(ids))
                words.append(p)
        raw = np.array(ids, "<u2").tobytes()
        known = {p: raw[2 * a : 2 * b] for p, a, b in zip(words, ends[:-1], ends[1:])}
        alone = rest
        if before:
            joined = "\n".join(rest)
            marked, spaced = self.opens is None and MARK in joined, " " in joined
            alone = [p for p in rest if not p or p.strip() != p or marked and MARK in p or spaced and " " in p]
        for piece, code in zip(alone, self.model.encode_batch_fast([before + p for p in alone], add_special_tokens=False)):
            known[piece] = np.array(code.ids, dtype="<u2").tobytes()
        many = list(set(rest).difference(alone))
        blocks = [many[i : i + TOGETHER] for i in range(0, len(many), TOGETHER)]
        if self.opens is None:
            texts = ["".join(f" {p} {MARK}" for p in block) for block in blocks]
        else:
            texts = [" " + " ".join(block) for block in blocks]
        for block, code in zip(blocks, self.model.encode_batch_fast(texts, add_special_tokens=False)):
            known.update(zip(block, self._split(np.array(code.ids, dtype="<u2"), len(block))))
        return known

    def _split(self, ids: np.ndarray, n: int) -> list[bytes]:
        """The ids of ``n`` pieces, each followed by the mark's if it needs one."""
        if self.opens is not None:
            raw, starts = ids.tobytes(), np.flatnonzero(self.opens[ids])
            if len(starts) != n or starts[0]:
                raise AssertionError("pieces and spaces do not match")
            return [raw[2 * a : 2 * b] for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(ids)])]
        mark = np.frombuffer(self.mark, dtype="<u2")
        size = len(ids) - len(mark) + 1
        at = np.flatnonzero(np.logical_and.reduce([ids[j : size + j] == m for j, m in enumerate(mark)]))
        if len(at) != n:
            raise AssertionError("pieces and marks do not match")
        raw, starts = ids.tobytes(), np.concatenate([[0], at[:-1] + len(mark)])
        return [raw[2 * a : 2 * b] for a, b in zip(starts.tolist(), at.tolist())]
