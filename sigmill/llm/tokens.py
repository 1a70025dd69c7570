"""Token ids from the tokenizers library, with a bounded cache of words.

A byte-level BPE splits a text before each single space between two other non-space characters, whatever stands
around it. A text whose words are all separated by single spaces is therefore the concatenation of its
space-prefixed words' ids, and each distinct word, less punctuation at its end, goes to the library once. Any other
text goes there whole.
A tokenizer that drops white space before it splits words takes a text as the words between ASCII white space; each
distinct one goes to the library once, less ASCII punctuation behind a letter or digit.
A text that holds the content of an added token goes there whole too.
"""

from __future__ import annotations

import json
import os
import re
import string
from array import array
from collections.abc import Iterable, Iterator

import numpy as np

from ._shared import slices

#: Words in each of the cache's two generations: a full new one becomes the old one, and words in use move up again.
CACHE_WORDS = 700_000
#: Texts of about so many characters are looked up together.
GROUP_CHARS = 30_000
END_ID = 2


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


#: Longer words are not kept.
LONG_WORD = 64
#: Fixed value: how a tokenizer that drops white space splits words.
SPACELESS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
PUNCTUATION = string.punctuation.encode()
#: Words of these letters stay whole, whatever is composed or lower-cased.
ONE_WORD = re.compile("[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u024f]+").fullmatch
#: Unknown words that go to the library as one text.
JOINED = 500
ALNUM = frozenset((string.ascii_letters + string.digits).encode())


def _plain(word: str) -> bool:
    return bool(word) and not word[0].isspace() and not word[-1].isspace()


def _cuts(word: str) -> list[str] | None:
    """The cache keys of the parts of a word that the tokenizer never joins; None if its neighbours could matter.

    Single line breaks stand alone, and so does ASCII punctuation behind a Latin letter or digit, unless an apostrophe
    leads it.
    """
    core = word.rstrip(string.punctuation)
    if core.isascii() and core.isalnum():  # the usual case: one line, punctuation at its end at most
        if len(core) == len(word):
            return [word]
        return [word] if word[len(core)] == "'" else [core, " " + word[len(core) :]]
    out = []
    for k, line in enumerate(word.split("\n")):
        if not _plain(line):
            return None
        core = line.rstrip(string.punctuation)
        last = core[-1:]
        if k:
            out.append(" \n")
        lead = " " if k else ""
        if len(core) < len(line) and last.isalnum() and last < "\u0250" and line[len(core)] != "'":
            out += (lead + core, " " + line[len(core) :])
        else:
            out.append(lead + line)
    return out


def _byte_level(library) -> bool:
    """Whether the tokenizer splits texts by the byte-level pattern and does nothing else to them."""
    if library.normalizer is not None or library.pre_tokenizer is None:
        return False
    how = json.loads(library.pre_tokenizer.__getstate__())
    return how["type"] == "ByteLevel" and how.get("use_regex", True) and not how["add_prefix_space"]


def _drops_space(library) -> bool:
    """Whether the tokenizer takes white space as nothing but a boundary: words between it have the ids they have alone."""
    if library.normalizer is None or library.pre_tokenizer is None:
        return False
    norm, how = (json.loads(x.__getstate__()) for x in (library.normalizer, library.pre_tokenizer))
    split = how.get("pretokenizers", [{}])[0]
    return [x["type"] for x in norm.get("normalizers", [])] == ["NFC", "Replace", "Lowercase"] and norm["normalizers"][1] == {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "} and split == {"type": "Split", "pattern": {"Regex": SPACELESS}, "behavior": "Removed", "invert": True} and [x["type"] for x in how["pretokenizers"][1:]] == ["ByteLevel"] and not how["pretokenizers"][1]["add_prefix_space"] and not how["pretokenizers"][1]["use_regex"]


class Encoder:
    """ids(text): little-endian unsigned 32-bit ids. One encoder a Python worker."""

    _made: dict[tuple[str, int], Encoder] = {}

    def __init__(self, path: str, cache_words: int = CACHE_WORDS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.cache_words = cache_words
        self.library = Tokenizer.from_file(path)
        #: Texts with one of these go to the library whole: it cuts them out before it splits words.
        self.added = [t.content for t in self.library.get_added_tokens_decoder().values()]
        #: The cache holds for byte-level splitting alone; with any other tokenizer all texts go to the library whole.
        self.by_words = _byte_level(self.library)
        self.spaceless = _drops_space(self.library)
        #: Whether a token begins a word behind a space, or ends a word of letters where white space is dropped.
        mark = (lambda t: t.endswith("</w>")) if self.spaceless else (lambda t: t.startswith("\u0120"))
        vocabulary = self.library.get_vocab() if self.spaceless or self.by_words else {}
        self.marks = np.zeros(max(vocabulary.values(), default=0) + 1, bool)
        self.marks[[k for t, k in vocabulary.items() if mark(t)]] = True
        #: A word: the ids of it with a space before. A space and a word: the ids of it alone.
        self.cache: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    @classmethod
    def of(cls, path: str, cache_words: int = CACHE_WORDS) -> Encoder:
        if (path, cache_words) not in cls._made:
            cls._made[path, cache_words] = cls(path, cache_words)
        return cls._made[path, cache_words]

    def _encode(self, texts: list[str]) -> list[bytes]:
        return [array("I", e.ids).tobytes() for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def _encode_words(self, words: list[str]) -> Iterator[bytes]:
        """The ids of words of which each has one marked token, JOINED of them to a text."""
        for k in range(0, len(words), JOINED):
            part = words[k : k + JOINED]
            ids = np.array(self.library.encode_batch_fast([("" if self.spaceless else " ") + " ".join(part)], add_special_tokens=False)[0].ids, "<u4")
            at = np.flatnonzero(self.marks[ids])
            cuts = np.r_[0, at + 1] if self.spaceless else np.r_[at, len(ids)]
            if len(at) == len(part) and cuts[-1] == len(ids):
                raw, cuts = ids.tobytes(), (4 * cuts).tolist()
                yield from [raw[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]
            else:
                yield from self._encode(part if self.spaceless else [" " + w for w in part])

    def ids(self, text: str | None) -> bytes:
        return self._group([text])[0]

    def _between_spaces(self, texts: list[str | None]) -> list[bytes]:
        """As _group, for a tokenizer that drops white space. The cache has words as UTF-8."""
        words = [None if t is None or any(a in t for a in self.added) else t.encode("utf-8", "replace").split() for t in texts]
        get, found = self.cache.get, [None if w is None else list(map(self.cache.get, w)) for w in words]
        missing = {x for w, f in zip(words, found, strict=True) if f and None in f for x, ids in zip(w, f, strict=True) if ids is None}
        again = {w for w in missing if w in self.old}
        self.cache.update((w, self.old[w]) for w in again)
        parts = {}
        for w in missing.difference(again):
            core = w.rstrip(PUNCTUATION)
            parts[w] = (core, w[len(core) :]) if core and core[-1] in ALNUM and len(core) < len(w) and b"'" not in w else (w,)
        new = {x: x.decode() for p in parts.values() for x in p if x not in self.cache}
        easy = {x: w for x, w in new.items() if ONE_WORD(w)}
        self.cache.update(zip(easy, self._encode_words(list(easy.values())), strict=True))
        other = [x for x in new if x not in easy]
        self.cache.update(zip(other, self._encode([new[x] for x in other]), strict=True))
        self.cache.update((w, get(p[0]) + get(p[1])) for w, p in parts.items() if len(p) > 1)
        out = []
        for text, w, f in zip(texts, words, found, strict=True):
            if w is None:
                out.append(self._encode([text])[0] if text else b"")
            else:
                out.append(b"".join(map(get, w) if None in f else f))
        for w in {*new, *parts}:
            if len(w) > LONG_WORD:
                self.cache.pop(w, None)
        return out

    def _group(self, texts: list[str | None]) -> list[bytes]:
        """The ids of a few texts; their unknown words go to the library together."""
        if len(self.cache) > self.cache_words:
            self.old, self.cache = self.cache, {}
        if self.spaceless:
            return self._between_spaces(texts)
        whole = [t is not None and (not self.by_words or any(a in t for a in self.added)) for t in texts]
        parts = [("" if w else t or "").split(" ") for t, w in zip(texts, whole, strict=True)]
        heads = [" " + words[0] for words in parts]
        parts = [words[1:] for words in parts]
        found = [list(map(self.cache.get, words)) for words in parts]
        missing = {w for w in heads if w not in self.cache}
        missing.update(w for words, f in zip(parts, found, strict=True) if None in f for w, ids in zip(words, f, strict=True) if ids is None)
        again = {w for w in missing if w in self.old}  # an intersection would walk the whole of the old words
        self.cache.update((w, self.old[w]) for w in again)
        missing.difference_update(again)
        easy = [w for w in missing if w.isalpha()]
        cuts = {w: c for w in missing.difference(easy, heads) if (c := _cuts(w))}
        new = {x for c in cuts.values() for x in c if x not in self.cache}.union(w for w in missing.intersection(heads) if _plain(w[1:])).difference(easy)
        easy += [w for w in new if w[0] != " " and len(w.split()) == 1]
        new.difference_update(easy)
        self.cache.update(zip(easy, self._encode_words(easy), strict=True))
        new = list(new)
        self.cache.update(zip(new, self._encode([w[1:] if w[0] == " " else " " + w for w in new]), strict=True))
        self.cache.update((w, b"".join([self.cache[x] for x in c])) for w, c in cuts.items() if len(c) > 1)
        out = []
        for text, alone, head, words, f in zip(texts, whole, heads, parts, found, strict=True):
            if alone:
                out.append(self._encode([text])[0])
                continue
            try:
                out.append(self.cache[head] + b"".join(map(self.cache.__getitem__, words) if None in f else f))
            except KeyError:  # a word that is not plain: its neighbours matter
                out.append(self._encode([text])[0] if text else b"")
        for w in {*new, *easy, *cuts}:
            if len(w) > LONG_WORD:
                self.cache.pop(w, None)
        return out

    def release(self) -> None:
        """For operators whose tasks are many and short, at a task's end: waiting workers then hold one generation."""
        self.old = {}

    def documents(self, texts: Iterable[str | None], end_id: int = END_ID) -> Iterator[np.ndarray]:
        """Each text's ids with the end id behind."""
        end = np.array([end_id], "<u4").tobytes()
        texts = list(texts)
        for a, b in slices([len(t or "") for t in texts], GROUP_CHARS):
            for ids in self._group(texts[a:b]):
                yield np.frombuffer(ids + end, "<u4")
