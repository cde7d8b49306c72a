"""Token ids of whole texts from a tokenizers file, by stretches of text that are encoded once for each worker.

No pre-token of the two files used here crosses from a non-space to a space, and neither normalises across one. So a text's ids
are those of its stretches (spaces, then non-spaces) one after another; tests compare them with the library's on whole texts.
"""

from __future__ import annotations

import os
import re
import struct
from functools import lru_cache

import numpy as np

#: Unicode's White_Space.
_WHITE = "\t-\r \x85\xa0  -     　"
#: Most stretches are a word of Latin letters, perhaps after a space or a line's end and before signs. Word (with its space), signs
#: and line's end are pre-tokens of their own, and taken apart here, so that few different ones come.
_LETTERS, _SIGNS = "A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\xff", r"!\"#$%&()*+,\-./:;=?@\[\]^_`{}~"
_WORD, _END = f" ?[{_LETTERS}]+", f"(?:[{_WHITE}]|\\Z)"
_WHOLE = f"[{_WHITE}]*[^{_WHITE}]+|[{_WHITE}]+"
_STRETCHES = re.compile(_WHOLE)
_PARTS = re.compile(f"{_WORD}(?=[{_SIGNS}]*{_END})|[{_SIGNS}]+(?={_END})|\n(?={_WORD})|{_WHOLE}")
_PLAIN = re.compile(_WORD)
#: Words are taken apart and given to the model alone only with a file that agrees with it on these.
_TRIED = ["a", "A", " a", " \xc9t\xe9", "\xd6l", "The", " the", "the.", " The,", " Stra\xdfe!?", " \xfeing;", "na\xefve:", "ANTIdisestablishment...", " \xe0\xc8\xfe\xff", "a\nThe", "a.\n the.", "\n\xc9t\xe9,", "...", "a \"b\" -- (c)."]
#: Texts are split only with a file that agrees with it on these and has no added token with a space in it or that takes spaces beside it.
_TRIED_TEXTS = ["  a  b\n\n c ", "don't 've\t\r\n x  ", "1 234,567\u00a0kg (a) [b]\n\n\n- \"q\" ...", "\u00c9t\u00e9 \u4e2d\u6587\u3000x\u2028y \U0001f600 z"]
#: Parts kept by a worker (about 80 MB), and the longest kept.
KEPT, LONGEST = 400_000, 64


class Encoder:
    def __init__(self, path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.known: dict[str, bytes] = {}
        self.model, self.as_bytes = self.tokenizer.model, self._letters()
        self.lower = self._whole("A") == self._whole("a")
        self.split = self.plain = True
        self.parts = _PARTS
        if not (all(self.as_bytes[i] == chr(i) for i in self.as_bytes if 32 < i < 128) and all(self.ids(x) == self._whole(x) for x in _TRIED)):
            self.plain, self.parts = False, _STRETCHES
        self.known.clear()
        added = self.tokenizer.get_added_tokens_decoder().values()
        self.split = not any(t.lstrip or t.rstrip or re.search(f"[{_WHITE}]", t.content) for t in added) and all(self.ids(t) == self._whole(t) for t in _TRIED_TEXTS)

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _letters(self) -> dict[int, str]:
        """How the file's own pre-tokenizer writes letters and a space before a letter; nothing for a space that it drops."""
        split = self.tokenizer.pre_tokenizer.pre_tokenize_str
        chars = [c for c in map(chr, range(256)) if re.match(f"[{_LETTERS}]", c)]
        return {ord(" "): split(" a")[0][0][:-1]} | {ord(c): split(c)[0][0] for c in chars}

    def _part(self, part: str) -> bytes:
        if (out := self.known.get(part)) is None:
            if self.plain and _PLAIN.fullmatch(part):
                out = self._word(part)
            else:
                out = self._whole(part)
            self._keep(part, out)
        return out

    def _word(self, word: str) -> bytes:
        """The ids of a word by the model alone, as neither normaliser nor pre-tokenizer has more to do with it than this."""
        lower = word.lower() if self.lower else word
        if lower != word:
            return self._part(lower)
        ids = [t.id for t in self.model.tokenize(word.translate(self.as_bytes))]
        return struct.pack(f"<{len(ids)}I", *ids)

    def _keep(self, part: str, ids: bytes) -> None:
        if len(part) > LONGEST:
            return
        if len(self.known) >= KEPT:
            # The first ones came early because they are frequent; the later half makes room.
            for x in list(self.known)[KEPT // 2 :]:
                del self.known[x]
        self.known[part] = ids

    def ids(self, text: str | None) -> bytes:
        """The ids as little-endian unsigned 32-bit integers."""
        if not self.split:
            return self._whole(text or "")
        parts = self.parts.findall(text or "")
        out = list(map(self.known.get, parts))
        if None in out:
            out = [self._part(x) if ids is None else ids for x, ids in zip(parts, out, strict=True)]
        return b"".join(out)


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One for each worker process and file. The file must be at the same path on all machines, as an installed package is."""
    return Encoder(path)
