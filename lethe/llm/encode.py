"""Token ids of whole texts, word by word.

The vocabulary's pre-tokenizer never joins across white space, so a text's ids are
those of its space-separated words in turn.  A process remembers the ids of the
words it met first, a bounded number; other words are encoded once per block.

Most words hold printable ASCII and accented Latin letters only.  These are in normal
form already, so their parts go to the merges directly; all others go through the
vocabulary's own normalizer and pre-tokenizer, which take four times as long.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from functools import lru_cache

import numpy as np

END = 1  # id that ends a document
REMEMBERED = 400_000  # words whose ids a process keeps
WORDS_AT_ONCE = 200_000
_LETTERS = "a-z\xdf-\xf6\xf8-\xff"
_SIMPLE = re.compile(f"[!-~{_LETTERS}]+")
# Fixed value: the pre-tokenizer's pattern, for such words in lower case.
_PARTS = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[0-9]|[^0-9{_LETTERS}]+")
_WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def _byte_characters() -> dict[int, str]:
    """The character that stands for each byte: its own if that is visible."""
    visible = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    hidden = [b for b in range(256) if b not in set(visible)]
    return {b: chr(b) for b in visible} | {b: chr(256 + n) for n, b in enumerate(hidden)}


@lru_cache(maxsize=2)
def encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


class WordEncoder:
    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.kind = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.pack = "H" if self.kind.itemsize == 2 else "I"
        self.known: dict[bytes, bytes] = {}
        self.characters = _byte_characters()
        layout = json.loads(self.tokenizer.to_str())
        self.direct = _WORD_PATTERN in json.dumps(layout["pre_tokenizer"], ensure_ascii=False).replace(
            "\\\\", "\\"
        ) and [n["type"] for n in layout["normalizer"].get("normalizers", [])] == ["NFC", "Replace", "Lowercase"]

    def _ids(self, words: list[bytes]) -> dict[bytes, bytes]:
        own, rest = {}, []
        tokenize, pack = self.tokenizer.model.tokenize, self.pack
        for word in words:
            text = word.decode(errors="replace").lower()
            if text.isalpha() and text.isascii() and self.direct:
                own[word] = array(pack, [t.id for t in tokenize(text)]).tobytes()
                continue
            if not self.direct or "<|" in text or not _SIMPLE.fullmatch(text):
                rest.append(word)
                continue
            ids = []
            for part in _PARTS.findall(text):
                if not part.isascii():
                    part = "".join(map(self.characters.__getitem__, part.encode()))
                ids += [t.id for t in tokenize(part)]
            own[word] = array(pack, ids).tobytes()
        return own | self._by_tokenizer(rest) if rest else own

    def _by_tokenizer(self, words: list[bytes]) -> dict[bytes, bytes]:
        encoded = self.tokenizer.encode_batch_fast(
            [w.decode(errors="replace") for w in words], add_special_tokens=False
        )
        return {
            w: np.array(e.ids, dtype=self.kind).tobytes()
            for w, e in zip(words, encoded, strict=True)
        }

    def encode(self, text: bytes) -> bytes:
        """Ids of ``text`` without the end id, as little-endian numbers of ``kind``."""
        words, known = text.split(), self.known
        parts = []
        for at in range(0, len(words), WORDS_AT_ONCE):
            some = words[at : at + WORDS_AT_ONCE]
            new = [w for w in dict.fromkeys(some) if w not in known]
            if new:
                own = self._ids(new)
                if len(known) + len(own) <= REMEMBERED:
                    known.update(own)
                else:
                    parts.extend(own[w] if w in own else known[w] for w in some)
                    continue
            parts.extend(map(known.__getitem__, some))
        return b"".join(parts)

    def encode_all(self, texts: list[bytes]) -> list[bytes]:
        """Ids of several texts; words new to the process are encoded together."""
        out: list[bytes] = []
        block: list[bytes] = []
        size = 0
        for text in texts:
            block.append(text)
            size += len(text)
            if size >= 1 << 20:
                out.extend(self._block(block))
                block, size = [], 0
        return out + self._block(block)

    def _block(self, texts: list[bytes]) -> list[bytes]:
        if len(texts) == 1 or not texts:
            return [self.encode(t) for t in texts]
        known = self.known
        split = [t.split() for t in texts]
        new = [w for w in set().union(*split) if w not in known]
        own = self._ids(new) if new else {}
        if len(known) + len(own) <= REMEMBERED:
            known.update(own)
            return [b"".join(map(known.__getitem__, words)) for words in split]
        return [b"".join([own[w] if w in own else known[w] for w in words]) for words in split]

    def with_end(self, ids: bytes) -> np.ndarray:
        """The ids as unsigned 32-bit numbers, with the end id."""
        numbers = np.frombuffer(ids, dtype=self.kind).astype("<u4")
        return np.append(numbers, np.array([END], dtype="<u4"))
