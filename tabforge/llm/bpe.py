"""BPE tables of a ``tokenizers`` JSON file, and its text preparation.

The file's bytes travel to the tasks as one broadcast (its size is fixed by
the vocabulary, not by the data). A pre-token's pieces never span white space,
so tasks prepare and remember white-space separated chunks one by one.
"""

from __future__ import annotations

import json
import unicodedata
from dataclasses import dataclass
from itertools import filterfalse

import numpy as np

# White space as the file's patterns mean it (the Unicode property).
SPACE = "\t-\r \x85\xa0  -     　"
# str.split() also splits at these four controls, which are not white space there
ODD = ("\x1c", "\x1d", "\x1e", "\x1f")


@dataclass
class Bpe:
    """Symbols are vocabulary ids below 2**16; ``merges`` maps a pair, as
    ``left << 16 | right``, to ``rank << 16 | merged id``."""

    tokens: dict[int, str]
    first: list[int]      # byte -> id inside a word
    last: list[int]       # byte -> id at a word's end
    merges: dict[int, int]
    special: dict[str, int]
    pattern: object       # compiled pre-token pattern
    special_pattern: object
    space: object
    lower: bool
    nfc: bool

    def chunks(self, text: str) -> list[str]:
        """White-space separated chunks of a text."""
        if any(c in text for c in ODD):
            return [c for c in self.space.split(text) if c]
        return text.split()

    def pre_tokens(self, chunk: str) -> list[bytes | int]:
        """UTF-8 pre-tokens of a chunk, special strings as their ids."""
        out: list[bytes | int] = []
        parts = self.special_pattern.split(chunk) if self.special_pattern else [chunk]
        for part in parts:
            if part in self.special:
                out.append(self.special[part])
                continue
            if self.nfc and not part.isascii():
                part = unicodedata.normalize("NFC", part)
            if self.lower:
                # character by character: no special final sigma
                part = part.replace("Σ", "σ").lower()
            out += [p.encode() for p in self.pattern.findall(part)]
        return out

    def symbols(self, pre_token: bytes) -> list[int]:
        ids = [self.first[b] for b in pre_token]
        ids[-1] = self.last[pre_token[-1]]
        return ids


def byte_characters() -> list[str]:
    """The printable character that stands for each byte in byte-level BPE files."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    spare = iter(range(0x100, 0x200))
    chars = {b: chr(b) for b in shown}
    return [chars.get(b) or chr(next(spare)) for b in range(256)]


def parse(raw: bytes) -> Bpe:
    """Read a tokenizer file of the kind "byte-level BPE with word ends"."""
    import regex

    spec = json.loads(raw)
    model = spec["model"]
    vocab = model["vocab"]
    suffix = model.get("end_of_word_suffix") or ""
    chars = byte_characters()
    pairs = (m if isinstance(m, list) else m.split(" ") for m in model["merges"])
    merges = {vocab[a] << 16 | vocab[b]: r << 16 | vocab[a + b] for r, (a, b) in enumerate(pairs)}
    steps = (spec.get("normalizer") or {}).get("normalizers", [])
    kinds = {s["type"] for s in steps}
    split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    tokens = {i: t for t, i in vocab.items()} | {i: t for t, i in special.items()}
    longest = sorted(special, key=len, reverse=True)
    return Bpe(
        tokens=tokens,
        first=[vocab[c] for c in chars],
        last=[vocab[c + suffix] for c in chars],
        merges=merges,
        special=special,
        pattern=regex.compile(split["pattern"]["Regex"].replace(r"\s", SPACE)),
        special_pattern=regex.compile("(" + "|".join(map(regex.escape, longest)) + ")") if special else None,
        space=regex.compile(f"[{SPACE}]+"),
        lower="Lowercase" in kinds,
        nfc="NFC" in kinds,
    )


_PARSED: dict[int, Bpe] = {}


def parsed(raw: bytes) -> Bpe:
    """``parse``, once per Python worker."""
    key = hash(raw)
    if key not in _PARSED:
        _PARSED.clear()
        _PARSED[key] = parse(raw)
    return _PARSED[key]


class Memo:
    """Bounded memory of results by chunk, in two generations.

    When the young generation is full it becomes the old one; entries still in
    use move back when met again. At most ``2 * limit`` entries are held.
    """

    def __init__(self, limit: int):
        self.limit, self.young, self.old = limit, {}, {}

    def missing(self, chunks: set[str]) -> list[str]:
        """Chunks that must be computed; known ones are young afterwards."""
        if len(self.young) + len(chunks) > self.limit:
            self.old, self.young = self.young, {}
        need, young = [], self.young
        for c in filterfalse(young.__contains__, chunks):
            v = self.old.get(c)
            if v is None:
                need.append(c)
            else:
                young[c] = v
        return need

    def has(self, chunk) -> bool:
        """``not missing({chunk})``."""
        if chunk in self.young:
            return True
        return not self.missing({chunk})


class PairRanks:
    """Merge ranks as sorted arrays, looked up for whole arrays of pairs."""

    NONE = np.int64(1) << 40

    def __init__(self, bpe: Bpe):
        keys = np.fromiter(bpe.merges, np.int64, len(bpe.merges))
        order = np.argsort(keys)
        self.keys = keys[order]
        both = np.fromiter(bpe.merges.values(), np.int64, len(keys))[order]
        self.ranks, self.ids = both >> 16, both & 0xFFFF

    def of(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank (``NONE`` if the pair does not merge) and merged id per pair."""
        if not len(self.keys):
            return np.full(len(left), self.NONE), np.zeros(len(left), np.int64)
        key = left << 16 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        hit = self.keys[at] == key
        return np.where(hit, self.ranks[at], self.NONE), self.ids[at]
