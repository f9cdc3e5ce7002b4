"""Token ids of whole texts by the tokenizers library, with what was encoded before remembered.

The library splits every text before it merges, and never merges across a
split. Texts are cut here into stretches at places where the library splits
too; every distinct stretch goes through ``Tokenizer.encode`` once and is found
again by its characters. Cuts are made among ASCII and the oldest accented
letters only, where all versions of Unicode agree: a word with any other
character stays whole, and so does a text in which the surroundings of such a
word could matter.
"""

from __future__ import annotations

import json
import re
from array import array

import numpy as np

#: Stretches remembered, about 200 bytes each; beyond it the encoder starts anew.
MOST = 1_000_000
#: The same for workers that go on with other operators: less memory, more merging.
FEW = 150_000
#: Stretches handed to the library at once.
CALL = 1 << 14

# Letters that are letters, and stay one character in lower case, in every version of Unicode;
# white space beyond ASCII; and how the two kinds of public files split such text.
_LETTER = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u017f"
_WIDE = "\x80-\u00bf\u00d7\u00f7\u0130\u0180-\U0010ffff"
_WIDE_SPACE = "\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_SPACE = " \t-\r"
_SHORT = "'(?:[stmd]|re|ve|ll)"
_SPACED = f" ?[{_LETTER}]+|{_SHORT}| ?[0-9]+| ?[^{_SPACE}{_LETTER}0-9]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+"
_SPACELESS = f"[{_LETTER}]+|{_SHORT}|[0-9]|[^{_SPACE}{_LETTER}0-9]+"
# A word with a character of any other kind stays whole.
_WORD = f"[^{_SPACE}{_WIDE}]*[{_WIDE}][^{_SPACE}]*"
_HAS_WIDE, _HAS_WIDE_SPACE = re.compile(f"[{_WIDE}]").search, re.compile(f"[{_WIDE_SPACE}]").search
_CUT_SPACED, _CUT_SPACED_WIDE = re.compile(_SPACED).findall, re.compile(f" ?{_WORD}|{_SPACED}").findall
_CUT_SPACELESS, _CUT_SPACELESS_WIDE = re.compile(_SPACELESS).findall, re.compile(f"{_WORD}|{_SPACELESS}").findall
_LOWER = bytes(c + 32 if 0x41 <= c <= 0x5A else c for c in range(256))


class Encoder:
    """Ids of whole texts for one tokenizer file, exactly those of ``encode(text, add_special_tokens=False)``.

    Files that split as GPT-2's byte-level pattern does, or as CLIP's lower-case
    pattern does, are cut into stretches; a file of any other kind, and every
    text that holds one of the file's added tokens, goes to the library whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        added = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.added = re.compile("|".join(map(re.escape, added)) or "(?!)", re.IGNORECASE)
        self.cut = self._cutter()
        #: stretch -> its ids as little-endian unsigned 32-bit numbers
        self.seen: dict[str, bytes] = {}
        #: Stretches to remember; None: ``MOST``
        self.most: int | None = None

    def _cutter(self):
        parts = json.loads(self.library.to_str())
        before, normal = parts["pre_tokenizer"], parts["normalizer"]
        if normal is None and before["type"] == "ByteLevel" and before["use_regex"] and not before["add_prefix_space"]:
            return self._spaced
        names = [n["type"] for n in (normal or {}).get("normalizers", [])]
        splits = (before or {}).get("pretokenizers", [{}])[0]
        if names == ["NFC", "Replace", "Lowercase"] and splits.get("pattern", {}).get("Regex", "").startswith("'s|'t|"):
            return self._spaceless
        return None

    @staticmethod
    def _spaced(text: str) -> list[str] | None:
        if not _HAS_WIDE(text):
            return _CUT_SPACED(text)
        # White space beyond ASCII changes how the spaces beside it are split.
        return None if _HAS_WIDE_SPACE(text) else _CUT_SPACED_WIDE(text)

    @staticmethod
    def _spaceless(text: str) -> list[str] | None:
        text = text.encode().translate(_LOWER).decode()
        return _CUT_SPACELESS_WIDE(text) if _HAS_WIDE(text) else _CUT_SPACELESS(text)

    def _whole(self, text: str) -> bytes:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _learn(self, stretches: list[str]) -> None:
        # A stretch of printable ASCII is what the library merges: no normaliser or splitter changes it further.
        merge = self.library.model.tokenize
        rest = []
        for stretch in stretches:
            if stretch.isascii() and stretch.isprintable():
                self.seen[stretch] = array("I", [t.id for t in merge(stretch.replace(" ", "\u0120"))]).tobytes()
            else:
                rest.append(stretch)
        stretches = rest
        for first in range(0, len(stretches), CALL):
            some = stretches[first:first + CALL]
            found = self.library.encode(some, is_pretokenized=True, add_special_tokens=False)
            ends = np.searchsorted(np.array(found.word_ids, np.int64), np.arange(len(some)), side="right")
            raw, start = np.array(found.ids, "<u4").tobytes(), 0
            for stretch, end in zip(some, (4 * ends).tolist()):
                self.seen[stretch], start = raw[start:end], end

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of every text as little-endian unsigned 32-bit numbers; NULL counts as empty."""
        if len(self.seen) > (MOST if self.most is None else self.most):
            self.seen.clear()
        cut = [None if not self.cut or self.added.search(t or "") else self.cut(t or "") for t in texts]
        stretches = set().union(*filter(None, cut))
        self._learn(list(stretches.difference(self.seen)) if self.seen else list(stretches))
        ids_of = self.seen.__getitem__
        return [self._whole(t or "") if c is None else b"".join(map(ids_of, c)) for t, c in zip(texts, cut)]


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str, most: int | None = None) -> Encoder:
    """The encoder of this Python process; later tasks use what earlier ones remembered."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    _ENCODERS[path].most = most
    return _ENCODERS[path]


def public_tokenizer(name: str) -> str:
    """Where a public tokenizer's file is; the same on every machine that has the files installed."""
    import public_tokenizers

    return public_tokenizers.path(name)
