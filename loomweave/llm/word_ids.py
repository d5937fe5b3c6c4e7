"""Token ids of whole texts by a word-level byte-pair tokenizer file, through a worker cache.

The tokenizer (tokenizers library: NFC, lower case, words, end-of-word mark)
never joins characters over white space, so ids are looked up per
white-space-separated word and encoded only once per worker.  The words that
many texts miss go through the same merges by rank at once (tiktoken, the
end-of-word mark written as a byte that none of them has); a test holds both
equal.  Texts with a special token's string go through the library whole.
"""

from __future__ import annotations

import itertools
import json
import re
import unicodedata
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

#: The tokenizer file's own splitting rule (fixed value).
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: The same rule on lower-case ASCII, and between words.
ASCII_SPLIT = r"[a-z]+|[0-9]|'s|'t|'re|'ve|'m|'ll|'d|[^\x09-\x0d\x20a-z0-9]+|\n"
#: Entries of a worker's cache before it starts afresh; longer words are encoded each time.
CACHE = 400_000
LONGEST = 64
END = b"\x01"

_loaded: dict = {}


class WordIds:
    """Encoder of one tokenizer file; ``encode`` gives ids as little-endian unsigned 32-bit bytes."""

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        if model["type"] != "BPE" or model["end_of_word_suffix"] != "</w>" or spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"] != SPLIT:
            raise ValueError(f"{path}: not a word-level BPE file of the kind this encoder knows")
        self.library = Tokenizer.from_file(path)
        self.special = [t["content"].encode().lower() for t in spec["added_tokens"]]
        byte_of = self._byte_characters()

        def raw(token: str) -> bytes:
            body = token[:-4] if token.endswith("</w>") else token
            return bytes(byte_of[c] for c in body) + (END if body != token else b"")

        ranked = [bytes([b]) for b in range(256)] + [bytes([b]) + END for b in range(256)]
        known = set(ranked)
        for merge in model["merges"]:
            a, b = merge if isinstance(merge, list) else merge.split(" ")
            if (t := raw(a) + raw(b)) not in known:
                known.add(t)
                ranked.append(t)
        names = {t["content"] for t in spec["added_tokens"]}
        number = {raw(t): i for t, i in model["vocab"].items() if t not in names}
        self.ids = np.array([number[t] for t in ranked], dtype="<u4")
        self.merges = tiktoken.Encoding("words", pat_str=r"[^\x01]+\x01", mergeable_ranks={t: i for i, t in enumerate(ranked)}, special_tokens={})
        self.between = ranked.index(b"\n" + END)
        self.split, self.ascii = regex.compile(SPLIT + r"|\n"), re.compile(ASCII_SPLIT)
        self.cache: dict[bytes, bytes] = {}

    @staticmethod
    def _byte_characters() -> dict[str, int]:
        """The byte-level alphabet: printable Latin-1 bytes stand for themselves, the others follow from 256 on."""
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        other = [b for b in range(256) if b not in shown]
        return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(other)}

    def _whole(self, text: str) -> bytes:
        return array("I", self.library.encode(text, add_special_tokens=False).ids).tobytes()

    def _words(self, words: list[bytes]) -> dict[bytes, bytes]:
        """The ids of words, none with the end mark's byte, of one run through the merges."""
        text = b"\n".join([*words, b""]).decode("utf-8")
        if text.isascii():
            tokens = self.ascii.findall(text)
        else:
            # character by character: a sigma at a word's end is no exception
            tokens = self.split.findall(unicodedata.normalize("NFC", text).replace("\u03a3", "\u03c3").lower())
        mark = END.decode()
        ranks = np.array(self.merges.encode_ordinary(mark.join(tokens) + mark), dtype=np.int64)
        ends = np.flatnonzero(ranks == self.between)
        ids, stops = self.ids[ranks].tobytes(), (ends * 4).tolist()
        return {w: ids[a:b] for w, a, b in zip(words, [0, *[e + 4 for e in stops[:-1]]], stops, strict=True)}

    def encode(self, text: str) -> bytes:
        return self.encode_all(pa.array([text], pa.string()))[0]

    def encode_all(self, texts: pa.Array) -> list[bytes]:
        """The ids of each text: every distinct word is looked up once, the words that all of them miss are encoded together."""
        lower = pc.ascii_lower(texts)
        odd = pc.match_substring(lower, END.decode())
        for s in self.special:
            odd = pc.or_(odd, pc.match_substring(lower, s.decode()))
        split = pc.ascii_split_whitespace(pc.if_else(odd, "", lower))
        words = split.flatten().dictionary_encode()
        cache, distinct = self.cache, words.dictionary.cast(pa.large_binary()).to_numpy(zero_copy_only=False).tolist()
        got = list(map(cache.get, distinct))
        new = [w for w, ids in zip(distinct, got, strict=True) if ids is None]
        if new:
            plain, other = [w for w in new if w.isascii()], [w for w in new if not w.isascii()]
            made = (self._words(plain) if plain else {}) | (self._words(other) if other else {})
            got = [made[w] if ids is None else ids for w, ids in zip(distinct, got, strict=True)]
            if len(cache) + len(made) > CACHE:
                cache.clear()
            if len(made) <= CACHE:
                cache.update((w, ids) for w, ids in made.items() if len(w) <= LONGEST)
        # the words' ids one after the other, each word's taken from the table of the distinct ones
        codes = words.indices.to_numpy(zero_copy_only=False)
        size = np.fromiter(map(len, got), dtype=np.int64, count=len(got)) // 4
        table, sizes = np.frombuffer(b"".join(got), dtype="<u4"), size[codes]
        ends = np.cumsum(sizes)
        ids = table[np.repeat((np.cumsum(size) - size)[codes] - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)].tobytes()
        at = (np.concatenate([[0], ends])[split.offsets.to_numpy() - split.offsets[0].as_py()] * 4).tolist()
        out = [ids[a:b] for a, b in itertools.pairwise(at)]
        for i in np.flatnonzero(odd.to_numpy(zero_copy_only=False)):
            out[i] = self._whole(texts[i].as_py())
        return out


def encoder(path: str) -> WordIds:
    """The encoder of a file, loaded once per worker."""
    if path not in _loaded:
        _loaded[path] = WordIds(path)
    return _loaded[path]
