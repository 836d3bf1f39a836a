"""Byte-pair encoding by depth-first traversal of the trie of distinct words.

The distinct words of a slice of texts, sorted as bytes, are the leaves of a trie in depth-first
order; a stack holds one state for each byte on the path from the root.  The state of a prefix is
the *last token* of its encoding.  Encodings of prefixes determine each other: the last token of a
prefix is the one token ``t`` among its suffixes for which the last token of the shortened prefix
and ``t`` stay two tokens when encoded side by side.  Two neighbouring words share the states of
their common prefix, so each shared prefix is encoded once, and a word's tokens are read off
backwards through the states.

The words go through no shuffle: they are met where their text is, and encodings of earlier
words stay in a cache of bounded size in the Python worker.
"""

from __future__ import annotations

import gc
import hashlib
import json
import re
from functools import lru_cache

import numpy as np
import regex
from pyspark.sql import DataFrame

from vigia.llm.common import annotate

#: Bytes that a task keeps of encodings of words and of pieces between spaces, and of pairs of tokens, about; each is emptied beyond,
#: which changes no result, and both go with the task.
WORD_BYTES, PAIR_BYTES = 80_000_000, 8_000_000
#: What Python takes for an entry of either, besides the characters and bytes in it.
WORD_ENTRY, PAIR_ENTRY = 190, 170
#: Longer words are encoded and forgotten.
CACHE_BYTES = 24
#: Fixed value: how the byte-level pre-tokenizer cuts a text into words.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in a byte-level vocabulary."""
    plain = {*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)}
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


class Codec:
    """Encoder and decoder of one byte-level vocabulary file (the JSON of the tokenizers library)."""

    def __init__(self, content: str):
        spec = json.loads(content)
        self._check(spec)
        letters = {letter: byte for byte, letter in enumerate(byte_letters())}
        as_bytes = lambda word: bytes(letters[c] for c in word)
        self.ids = {as_bytes(word): i for word, i in spec["model"]["vocab"].items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.table = {i: word for word, i in self.ids.items()}
        self.table |= {i: word.encode() for word, i in self.special.items()}
        order = range(max(self.table) + 1)
        self.flat = np.frombuffer(b"".join(self.table.get(i, b"") for i in order), dtype=np.uint8)
        self.sizes = np.array([len(self.table.get(i, b"")) for i in order], dtype=np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.packed = {i: int(i).to_bytes(4, "little") for i in self.table}
        self.rank: dict[tuple[int, int], int] = {}
        made: dict[int, tuple[int, int, int]] = {}
        for rank, merge in enumerate(spec["model"]["merges"]):
            left, right = (as_bytes(x) for x in (merge if isinstance(merge, list) else merge.split(" ")))
            a, b, whole = self.ids[left], self.ids[right], self.ids[left + right]
            self.rank[a, b] = rank
            made.setdefault(whole, (rank, a, b))
        self.right = {i: self._spine(i, made, 2) for i in self.ids.values()}
        self.left = {i: self._spine(i, made, 1) for i in self.ids.values()}
        ending: dict[bytes, set[int]] = {}
        for word in self.ids:
            ending.setdefault(word[-2:], set()).add(len(word))
        self.ending = {b: tuple(sorted(n | ({1} if len(b) > 1 else set()), reverse=True)) for b, n in ending.items()}
        self.forget()
        self.run = re.compile(r"\s\s")
        self.pattern = regex.compile(WORDS)
        self.cut = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None

    def forget(self) -> None:
        """Empties what is kept of earlier texts; only the vocabulary's own tables stay."""
        self.apart: dict[tuple[int, int], bool] = {}
        self.known: dict[str, bytes] = {}
        self.known_bytes = 0

    @staticmethod
    def _check(spec: dict) -> None:
        pre = spec.get("pre_tokenizer") or {}
        if spec["model"]["type"] != "BPE" or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or spec.get("normalizer"):
            raise ValueError("only byte-level BPE vocabularies without normaliser and prefix space are understood")

    @staticmethod
    def _spine(token: int, made: dict[int, tuple[int, int, int]], side: int) -> list[tuple[int, float]]:
        """The symbols that stand at one end of ``token`` while it is built, each with the rank of the merge that ends it."""
        found, ends = [(token, float("inf"))], float("inf")
        while token in made:
            ends, token = made[token][0], made[token][side]
            found.append((token, ends))
        return found

    def stay_apart(self, a: int, b: int) -> bool:
        """Whether ``a`` and ``b`` side by side are encoded as just these two.

        A merge across the seam happens if both its symbols stand there when its turn comes; of
        equal merges the one further left goes first.
        """
        known = self.apart.get((a, b))
        if known is None:
            if len(self.apart) * PAIR_ENTRY > PAIR_BYTES:
                self.apart.clear()
            known = True
            for x, ends_x in self.right[a]:
                for y, ends_y in self.left[b]:
                    rank = self.rank.get((x, y))
                    if rank is not None and rank < ends_x and rank <= ends_y:
                        known = False
            self.apart[a, b] = known
        return known

    def encode_words(self, words: list[bytes]) -> dict[bytes, bytes]:
        """Ids of distinct words, packed as little-endian 32-bit integers."""
        ids, ending, packed, stay_apart, apart = self.ids, self.ending, self.packed, self.stay_apart, self.apart
        single = (1,)
        tokens: list[int] = [-1]
        lengths: list[int] = [0]
        found, before = {}, b""
        for word in sorted(words):
            shared, most = 0, min(len(word), len(before))
            while shared < most and word[shared] == before[shared]:
                shared += 1
            del tokens[shared + 1:], lengths[shared + 1:]
            for end in range(shared + 1, len(word) + 1):
                for size in ending.get(word[end - 2 if end > 1 else 0:end], single):
                    if size > end:
                        continue
                    token = ids.get(word[end - size:end])
                    if token is None:
                        continue
                    if size == end:
                        break
                    last = tokens[end - size]
                    fits = apart.get((last, token))
                    if fits or fits is None and stay_apart(last, token):
                        break
                tokens.append(token)
                lengths.append(size)
            parts, end = [], len(word)
            while end:
                parts.append(packed[tokens[end]])
                end -= lengths[end]
            found[word] = parts[0] if len(parts) == 1 else b"".join(reversed(parts))
            before = word
        return found

    def _encode_plain(self, texts: list[str]) -> list[bytes]:
        """Packed ids of texts without special tokens.

        Where white space never stands twice in a row, no word reaches across the single space before
        the next one, so that the pieces between spaces can be encoded, and remembered, by themselves.
        A space and letters are one word; other pieces are cut by the pattern.
        """
        if self.known_bytes > WORD_BYTES:
            self.known.clear()
            self.known_bytes = 0
        known, cut = self.known, self.pattern.findall
        split = [[t] if self.run.search(t) else [first, *[" " + x for x in rest]]
                 for t in texts for first, *rest in (t.split(" "),)]
        fresh = {p for ps in split for p in ps}.difference(known)
        several = {p: cut(p) for p in fresh if not p[1:].isalpha() or p[0] != " "}
        words = {w for ws in several.values() for w in ws}.difference(known)
        words.update(p for p in fresh if p not in several)
        as_bytes = {w: w.encode("utf-8", "replace") for w in words}
        encoded = self.encode_words(list(set(as_bytes.values())))
        known.update((w, encoded[b]) for w, b in as_bytes.items())
        known.update((p, b"".join([known[w] for w in ws])) for p, ws in several.items())
        out = [b"".join(map(known.__getitem__, ps)) for ps in split]
        for p in fresh | words:
            if len(p) > CACHE_BYTES:
                del known[p]
            else:
                self.known_bytes += WORD_ENTRY + 2 * len(p)
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        """Packed ids of each text; the strings of special tokens become these tokens."""
        if self.cut is None or not any(s in t for s in self.special for t in texts):
            return self._encode_plain(texts)
        split = [self.cut.split(t) for t in texts]
        plain = iter(self._encode_plain([p for parts in split for p in parts if p not in self.special]))
        return [b"".join(self.packed[self.special[p]] if p in self.special else next(plain) for p in parts) for parts in split]

    def decode(self, ids: bytes) -> str:
        """Bytes that are not UTF-8 become the replacement character."""
        tokens = np.frombuffer(ids, dtype="<u4")
        size = self.sizes[tokens]
        ends = np.cumsum(size)
        at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.starts[tokens] - ends + size, size)
        return self.flat[at].tobytes().decode("utf-8", "replace")


@lru_cache(maxsize=2)
def codec(content: str) -> Codec:
    return Codec(content)


def encode_documents(df: DataFrame, vocabulary: str, *, text: str = "text", ids: str = "ids", decoded: str = "decoded",
                     digests: bool = False) -> DataFrame:
    """``df`` with the token ids of the whole column ``text`` and the text decoded from them.

    ``vocabulary`` is the path of a byte-level BPE vocabulary, read on the driver (its size is that of the file) and sent
    to the tasks.  NULL counts as empty; an empty text has no ids and decodes to ''.  Repeated rows are encoded each, to
    the same result.  An empty table gives no rows.  Columns named like a new one are replaced, all others kept.
    With ``digests`` the columns are ``n_tokens``, ``ids_sha256`` and ``decoded_sha256`` in place of ids and text.
    """
    with open(vocabulary, encoding="utf-8") as file:
        content = df.sparkSession.sparkContext.broadcast(file.read())

    def make():
        tool = codec(content.value)

        def work(texts):
            gc.disable()  # millions of small objects and no cycles
            packed = tool.encode([t or "" for t in texts])
            gc.enable()
            back = (tool.decode(p) for p in packed)
            if digests:
                return {"n_tokens": [len(p) // 4 for p in packed],
                        "ids_sha256": [hashlib.sha256(p).hexdigest() for p in packed],
                        "decoded_sha256": [hashlib.sha256(b.encode()).hexdigest() for b in back]}
            return {ids: [np.frombuffer(p, dtype="<u4").astype(np.int64) for p in packed], decoded: list(back)}

        work.done = tool.forget
        return work

    fields = {"n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string"} if digests else {ids: "array<bigint>", decoded: "string"}
    return annotate(df, text, make, fields)
