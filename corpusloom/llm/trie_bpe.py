"""Byte-pair encoding over a trie of words, and decoding.

The ids of a word are those of a shorter prefix and one more token, the word's *last token*; the same
holds for every prefix. Of all tokens that end a prefix exactly one fits: the one whose neighbour to the
left, the last token of what stands before it, would not have merged with any part of it. So a trie over
the distinct words carries one last token per node: new words are inserted, and a depth-first walk over
the new nodes sets each from its ancestors. A prefix that many words share is encoded once.

Normalizing and cutting into words is left to the vocabulary's own parts; ids and decoding are made here.

Rows are independent: null, empty and blank texts have no ids; repeated rows, repeated or null ids each
keep their row; extra columns are not read; an empty table gives an empty result. A text of any length is
worked off in bounded parts, cut at white space, and between ASCII letters and digits where it has none.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import unicodedata
from collections import deque
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .tables import texts

#: Stretches between white space, and trie nodes, that a worker remembers; beyond it the memory starts anew.
REMEMBERED = 600_000
NODES = 800_000
#: Longer stretches and words are encoded, but not remembered.
LONG = 64
#: Characters of a text that are worked off at once.
PART = 1_000_000
NEVER = 1 << 40
#: The cut into words that has a form of its own for characters without composition, all but blanks and controls.
CUT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_PLAIN = re.compile("[!-~\xa1-\xac\xae-\u01ff]+")
#: Python splits at these; the vocabulary does not call them white space.
_NO_BLANK = re.compile(r"[\x1c-\x1f]")
_PLAIN_BLANK = re.compile(r"[ \t\n\r]+")
_INNER_CUT = re.compile(r"(?<=[A-Za-z0-9])(?=[0-9])")


def _byte_alphabet() -> dict[int, str]:
    """The printable character that stands for each byte: itself, or one from U+0100 on in the order of the others."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(0x100 + k) for k, b in enumerate(rest)}


BYTES = _byte_alphabet()


#: Number of ids, the ids as text, the decoded text.
Coded = tuple[int, str, str]


class Merges:
    """The merge rules: tokens as strings of symbols, and which tokens can stand side by side.

    A symbol is a character of the byte alphabet; the one that ends a word has ``END`` added to it.
    """

    END = 0x10000

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            self.file = json.load(f)
        model = self.file["model"]
        vocab, suffix = model["vocab"], model.get("end_of_word_suffix") or ""
        if model["type"] != "BPE" or model.get("dropout") or model.get("continuing_subword_prefix") or model.get("ignore_merges"):
            raise ValueError("only plain byte-pair models are read")
        self.parts: dict[int, tuple[int, int]] = {}
        self.made_at: dict[int, int] = {}
        self.rank: dict[tuple[int, int], int] = {}
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        spelt: dict[str, str] = {}
        made = {a + b for a, b in merges}
        for token in vocab:
            if token not in made:
                ends = suffix and token != suffix and token.endswith(suffix)
                symbol = token[: -len(suffix)] if ends else token
                if len(symbol) == 1:
                    spelt[token] = chr(ord(symbol) + self.END) if ends else symbol
        for at, (a, b) in enumerate(merges):
            token = vocab[a + b]
            if token in self.parts:
                raise ValueError("two merges make the same token")
            spelt[a + b] = spelt[a] + spelt[b]
            self.parts[token], self.made_at[token] = (vocab[a], vocab[b]), at
            self.rank[vocab[a], vocab[b]] = at
        self.suffix = bool(suffix)
        self.ids = {symbols: vocab[token] for token, symbols in spelt.items()}
        self.text = {i: token for token, i in vocab.items()}
        self.text.update((t["id"], t["content"]) for t in self.file.get("added_tokens", ()))
        self.known_beside: dict[tuple[int, int], bool] = {}
        self._stands: dict[int, bool] = {}

    def endings(self) -> tuple[list[dict[str, int]], list[int], list[tuple[tuple[int, int], ...]]]:
        """Aho-Corasick automaton of the tokens that can come up: steps, fall-backs, and per state the
        ``(length, token)`` that end there, the longest first."""
        steps: list[dict[str, int]] = [{}]
        own: list[tuple[tuple[int, int], ...]] = [()]
        for symbols, token in self.ids.items():
            if not self.stands(token):
                continue
            at = 0
            for symbol in symbols:
                if symbol not in steps[at]:
                    steps[at][symbol] = len(steps)
                    steps.append({})
                    own.append(())
                at = steps[at][symbol]
            own[at] = ((len(symbols), token),)
        back, todo = [0] * len(steps), deque(steps[0].values())
        while todo:
            at = todo.popleft()
            own[at] += own[back[at]]
            for symbol, to in steps[at].items():
                fall = back[at]
                while fall and symbol not in steps[fall]:
                    fall = back[fall]
                back[to] = steps[fall].get(symbol, 0)
                todo.append(to)
        return steps, back, own

    def _spine(self, token: int, side: int) -> list[int]:
        """The token, its outer part on one side, that one's outer part, and so on."""
        out = [token]
        while out[-1] in self.parts:
            out.append(self.parts[out[-1]][side])
        return out

    def _meet(self, left: int, right: int) -> bool:
        """Whether both tokens come whole before anything merges across the border between them."""
        a, b = self._spine(left, 1), self._spine(right, 0)
        x, y = a.pop(), b.pop()
        while a or b:
            grows_x = self.made_at[a[-1]] if a else NEVER
            grows_y = self.made_at[b[-1]] if b else NEVER
            across = self.rank.get((x, y), NEVER)
            if across < grows_x and across <= grows_y:
                return False
            if grows_x <= grows_y:
                x = a.pop()
            else:
                y = b.pop()
        return True

    def stands(self, token: int) -> bool:
        """Whether the token's own string encodes to the token; others never come up."""
        known = self._stands.get(token)
        if known is None:
            parts = self.parts.get(token)
            known = parts is None or (self.stands(parts[0]) and self.stands(parts[1]) and self._meet(*parts))
            self._stands[token] = known
        return known

    def beside(self, left: int, right: int) -> bool:
        """Whether the two tokens, side by side, stay as they are."""
        known = self.known_beside.get((left, right))
        if known is None:
            known = (left, right) not in self.rank and self._meet(left, right)
            if len(self.known_beside) > 2_000_000:
                self.known_beside.clear()
            self.known_beside[left, right] = known
        return known


class TrieEncoder:
    """Encodes words through a trie, texts through their words; one per worker."""

    def __init__(self, path: str, remembered: int = REMEMBERED, nodes: int = NODES):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.merges = Merges(path)
        library = Tokenizer.from_file(path)
        self.normalize: Callable[[str], str] = library.normalizer.normalize_str if library.normalizer else str
        self.cut = library.pre_tokenizer.pre_tokenize_str
        special = {t["content"]: t["id"] for t in self.merges.file.get("added_tokens", ())}
        if any(t.get(k) for t in self.merges.file.get("added_tokens", ()) for k in ("single_word", "lstrip", "rstrip", "normalized")):
            raise ValueError("added tokens with rules of their own are not read")
        self.special = special
        self.at_special = re.compile("(" + "|".join(map(re.escape, sorted(special, key=len, reverse=True))) + ")") if special else None
        self.steps, self.fall, self.endings = self.merges.endings()
        self.plain_word = self._plain_rule()
        self.remembered, self.most_nodes = remembered, nodes
        self.named = {i: str(i) for i in self.merges.text}
        # Two generations: what was met since the last turn outlives the next one.
        self.known: dict[str, Coded] = {}
        self.older: dict[str, Coded] = {}
        self._new_trie()

    def _plain_rule(self) -> re.Pattern | None:
        """The vocabulary's cut for characters below U+0200, where nothing composes; None if it is another one."""
        parts = self.merges.file.get("pre_tokenizer") or {}
        cut = next((p["pattern"]["Regex"] for p in parts.get("pretokenizers", ()) if p["type"] == "Split"), None)
        steps = [n["type"] for n in (self.merges.file.get("normalizer") or {}).get("normalizers", ())]
        if cut != CUT or steps != ["NFC", "Replace", "Lowercase"]:
            return None
        below = [chr(c) for c in range(0x300)]
        letters = "".join(c for c in below if unicodedata.category(c)[0] == "L")
        digits = "".join(c for c in below if unicodedata.category(c)[0] == "N")
        return re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{letters}]+|[{digits}]|[^\\s{letters}{digits}]+")

    def _new_trie(self) -> None:
        self.child: list[dict[str, int] | None] = [None]
        self.last = [-1]  # token that ends the prefix of a node
        self.back = [-1]  # node of the prefix without it
        self.state = [0]  # what tokens can end there

    # -- words

    def symbols(self, word: str) -> str:
        return word[:-1] + chr(ord(word[-1]) + Merges.END) if self.merges.suffix else word

    def encode_words(self, words: set[str]) -> dict[str, Coded]:
        """``(n, ids as text, decoded)`` of distinct words.

        Depth first: in sorted order a path shares its start with the one before it, and what branches off is
        inserted with its last tokens on the way down.
        """
        if len(self.last) > self.most_nodes:
            self._new_trie()
        child, last, back, state = self.child, self.last, self.back, self.state
        steps, endings, fits, beside = self.steps, self.endings, self.merges.known_beside, self.merges.beside
        line, before, out = [0] * (LONG + 1), "", {}
        for path, word in sorted((self.symbols(word), word) for word in words):
            if len(path) > LONG:
                out[word] = self._coded(self._one_path(path))
                continue
            depth = 0
            for x, y in zip(path, before):
                if x != y:
                    break
                depth += 1
            node = line[depth]
            for end in range(depth + 1, len(path) + 1):
                symbol, above = path[end - 1], node
                known = child[above]
                if known is None:
                    known = child[above] = {}
                node = known.get(symbol)
                if node is not None:
                    line[end] = node
                    continue
                node = line[end] = known[symbol] = len(child)
                to = steps[state[above]].get(symbol)
                if to is None:
                    to = self._step(state[above], symbol)
                for length, token in endings[to]:
                    left = line[end - length]
                    if length < end:
                        met = fits.get((last[left], token))
                        if not (beside(last[left], token) if met is None else met):
                            continue
                    break
                else:
                    raise AssertionError("no token ends this prefix")
                child.append(None)
                last.append(token)
                back.append(left)
                state.append(to)
            before = path
            trail = []
            while node:
                trail.append(last[node])
                node = back[node]
            trail.reverse()
            out[word] = self._coded(trail)
        return out

    def _coded(self, ids: list[int]) -> Coded:
        named, text = self.named, self.merges.text
        return len(ids), " ".join([named[i] for i in ids]), decode(ids, text)

    def _step(self, state: int, symbol: str) -> int:
        """The automaton's next state; steps that fall back are kept as steps of their own."""
        steps, fall = self.steps, self.fall
        at = state
        while at and symbol not in steps[at]:
            at = fall[at]
        to = steps[at].get(symbol, 0)
        if at != state and len(steps[state]) < 64:
            steps[state][symbol] = to
        return to

    def _one_path(self, path: str) -> list[int]:
        """The ids along one long word, outside the trie."""
        last, back, state, beside = [-1], [-1], 0, self.merges.beside
        for end, symbol in enumerate(path, 1):
            state = self._step(state, symbol)
            for length, token in self.endings[state]:
                if length == end or beside(last[end - length], token):
                    last.append(token)
                    back.append(end - length)
                    break
            else:
                raise AssertionError("no token ends this prefix")
        out, at = [], len(path)
        while at:
            out.append(last[at])
            at = back[at]
        return out[::-1]

    # -- texts

    def _pieces(self, stretch: str) -> list[str | int]:
        """Words of a stretch in the byte alphabet, special tokens as ids."""
        if self.plain_word and stretch.isascii():
            if stretch.isalpha():
                return [stretch.lower()]
            if stretch[-1] in ".," and stretch[:-1].isalpha():
                return [stretch[:-1].lower(), stretch[-1]]
        parts = self.at_special.split(stretch) if self.at_special else [stretch]
        out: list[str | int] = []
        for part in parts:
            if part in self.special:
                out.append(self.special[part])
            elif part and self.plain_word and _PLAIN.fullmatch(part):
                out.extend(w if w.isascii() else w.encode().decode("latin-1").translate(BYTES) for w in self.plain_word.findall(part.lower()))
            elif part:
                out.extend(word for word, _ in self.cut(self.normalize(part)) if word)
        return out

    def learn(self, stretches: set[str]) -> dict[str, Coded]:
        """What each stretch comes to, all their new words through the trie at once."""
        pieces = {s: self._pieces(s) for s in stretches}
        coded = self.encode_words({w for p in pieces.values() for w in p if isinstance(w, str)})
        out = {}
        for stretch, found in pieces.items():
            parts = [self._coded([w]) if isinstance(w, int) else coded[w] for w in found]
            out[stretch] = parts[0] if len(parts) == 1 else (
                sum([p[0] for p in parts]), " ".join([p[1] for p in parts]), " ".join([p[2] for p in parts])
            )
        return out

    def parts(self, text: str) -> Iterator[list[Coded]]:
        """The text's stretches, encoded, a bounded part of it at a time."""
        for part in _bounded(text):
            stretches = part.split() if _NO_BLANK.search(part) is None else [s for s in _PLAIN_BLANK.split(part) if s]
            if any(len(s) > PART for s in stretches):
                stretches = [c for s in stretches for c in (_INNER_CUT.split(s) if len(s) > PART else [s])]
            new = set(stretches).difference(self.known)
            if not new:
                yield list(map(self.known.__getitem__, stretches))
                continue
            if len(self.known) > self.remembered // 2:
                self.known, self.older = {}, self.known
                new = set(stretches)
            again = {s for s in new if s in self.older}
            met = self.learn(new - again)
            self.known.update((s, c) for s, c in met.items() if len(s) <= LONG)
            self.known.update((s, self.older[s]) for s in again)
            yield [self.known.get(s) or met[s] for s in stretches]


def _bounded(text: str) -> Iterator[str]:
    """Parts of some ``PART`` characters that end before white space."""
    start = 0
    while len(text) - start > PART:
        gap = _PLAIN_BLANK.search(text, start + PART)
        if gap is None:
            break
        yield text[start : gap.start()]
        start = gap.start()
    yield text[start:] if start else text


def decode(ids, text: dict[int, str]) -> str:
    """What the vocabulary makes of ids: it has no decoder of its own, so tokens stand side by side with a space."""
    return " ".join(text[i] for i in ids)


_workers: dict[str, TrieEncoder] = {}


def _encoder(path: str) -> TrieEncoder:
    if path not in _workers:
        _workers[path] = TrieEncoder(path)
    return _workers[path]


def encode(docs: DataFrame, path: str, *, with_ids: bool = True, with_text: bool = True) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` and, unless left out, ``ids`` and ``decoded``.

    path  vocabulary file, the same on every machine
    The hashes are of the decimal ids joined by a space, and of the decoded text. Without ``ids`` and
    ``decoded`` nothing of a text's size is held.
    """
    schema = T.StructType(
        [T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("n_tokens", T.LongType())]
        + [T.StructField(c, T.StringType()) for c in ("ids_sha256", "decoded_sha256")]
        + [T.StructField("ids", T.ArrayType(T.IntegerType()))] * with_ids
        + [T.StructField("decoded", T.StringType())] * with_text
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(path)
        for batch in batches:
            n, id_hash, text_hash, id_lists, decoded = [], [], [], [], []
            for text in batch.column(1):
                of_ids, of_text, count, gap = hashlib.sha256(), hashlib.sha256(), 0, ""
                ids, said = [], []
                for found in encoder.parts(text.as_py()):
                    found = [f for f in found if f[0]]
                    if found:
                        count += sum([f[0] for f in found])
                        of_ids.update((gap + " ".join([f[1] for f in found])).encode())
                        part = " ".join([f[2] for f in found])
                        of_text.update((gap + part).encode())
                        gap = " "
                        if with_ids:
                            ids.extend(int(i) for f in found for i in f[1].split(" "))
                        if with_text:
                            said.append(part)
                n.append(count)
                id_hash.append(of_ids.hexdigest())
                text_hash.append(of_text.hexdigest())
                id_lists.append(ids)
                decoded.append(" ".join(said))
            columns = [batch.column(0), pa.array(n, pa.int64()), pa.array(id_hash, pa.string()), pa.array(text_hash, pa.string())]
            columns += [pa.array(id_lists, pa.list_(pa.int32()))] * with_ids + [pa.array(decoded, pa.string())] * with_text
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return texts(docs).mapInArrow(run, schema)


def decode_ids(rows: DataFrame, path: str) -> DataFrame:
    """``(doc_id, text)`` of rows ``(doc_id, ids)``; null ids give an empty text, ids outside the vocabulary are an error."""
    schema = T.StructType([T.StructField("doc_id", rows.schema["doc_id"].dataType), T.StructField("text", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        text = _encoder(path).merges.text
        for batch in batches:
            said = [decode(ids.as_py() or (), text) for ids in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(said, pa.string())], names=schema.names)

    return rows.select("doc_id", "ids").mapInArrow(run, schema)
