"""Token ids of whole texts with the tokenizers library, a word encoded once per worker.

A byte-level tokenizer splits text into pieces before it merges: words, numbers and runs of marks with
the space before them, and other white space. A text's ids are those of its pieces, one after
another; they come from a bounded cache, and what is missing is merged by the library's model. That
holds for texts of characters on whose kind all versions of Unicode agree, see ``PIECES``.

In other texts, a single space between two visible characters still starts a new piece. Their ids
are those of space-separated units, of which the missing are encoded by the library many
at a time. Texts with any other space or with the string of an added token, and tokenizers of any
other kind, go to the library whole.
The ids are the library's either way, with its own defaults: such a string in a text becomes
the added token. Tests hold them against whole texts that the library alone encodes.
"""

from __future__ import annotations

import json
import os
import re
from functools import cache

import numpy as np

#: Units that a worker keeps, as many words without marks, and twice as many pieces; beyond that it starts anew.
KEPT = 600_000
LETTERS, NUMBERS = "A-Za-zªµºÀ-ÖØ-öø-ɏ", "0-9²³¹¼-¾"
OTHERS = r"!-/:-@\[-`{-~¡-©«-±´¶-¸»¿×÷"
#: The pieces of a byte-level tokenizer, in texts without an unknown character.
PIECES = re.compile(
    rf" ?[{LETTERS}]+|'(?:s|t|re|ve|m|ll|d)| ?[{NUMBERS}]+| ?[{OTHERS}]+|[ \t\n\r]+(?![^ \t\n\r])|[ \t\n\r]+"
)
UNKNOWN = re.compile(rf"[^{LETTERS}{NUMBERS}{OTHERS} \t\n\r]")
#: Trailing marks that form a piece of their own after a letter or digit.
MARKS = ".,;:!?*#$%&|"


def _visible(c: str) -> bool:
    """Characters that no version of Unicode counts as white space."""
    return "!" <= c <= "~" or "À" <= c <= "ɏ"


def _byte_characters() -> list[str]:
    """The character that stands for each byte: itself if it is visible, or else one beyond U+00FF."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = iter(range(0x100, 0x200))
    return [chr(b if b in shown else next(others)) for b in range(256)]


class Pieces(dict[str, bytes]):
    """The ids of pieces, merged by the model of a tokenizer when they are first asked for."""

    def __init__(self, model, raw: list[bytes]) -> None:
        byte = _byte_characters()
        self.model, self.raw = model, raw
        self.written = {k: "".join(byte[b] for b in chr(k).encode()) for k in range(0x250)}

    def __missing__(self, piece: str) -> bytes:
        if len(self) >= 2 * KEPT:
            self.clear()
        raw = self.raw
        ids = b"".join([raw[t.id] for t in self.model.tokenize(piece.translate(self.written))])
        self[piece] = ids
        return ids


class Encoder:
    def __init__(self, definition: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has a task for each core
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(definition)
        parts = json.loads(definition)
        vocabulary = self.library.get_vocab()
        self.dtype = np.dtype("<u2" if max(vocabulary.values(), default=0) < 1 << 16 else "<u4")
        before = parts.get("pre_tokenizer") or {}
        added = parts.get("added_tokens") or []
        #: Strings that the library looks for before it splits a text.
        self.added = [token["content"] for token in added if token["content"]]
        self.byte_level = (
            not parts.get("normalizer") and before.get("type") == "ByteLevel"
            and not before.get("add_prefix_space") and before.get("use_regex", True)
            and not any(" " in t["content"] or t.get("lstrip") or t.get("rstrip") for t in added)
        )
        #: Bytes of each id; a character of a byte-level token stands for one byte.
        self.width = np.zeros(max(vocabulary.values(), default=0) + 1, np.int64)
        for token, k in vocabulary.items():
            self.width[k] = len(token)
        for token in added:
            self.width[token["id"]] = len(token["content"].encode())
        self.pieces = Pieces(
            self.library.model, [k.tobytes() for k in np.arange(len(self.width), dtype=self.dtype)]
        )
        self.units: dict[str, bytes] = {}
        self.cores: dict[str, bytes] = {}
        self.tails: dict[str, bytes] = {}

    def _whole(self, text: str) -> bytes:
        found = self.library.encode_batch_fast([text], add_special_tokens=False)[0]
        return np.array(found.ids, self.dtype).tobytes()

    def _learn(self, missing: set[str], wanted: set[str]) -> None:
        """Cache ``missing`` units, each as it reads after a space. Those with other white
        space at an end are left out. All ``wanted`` units are there afterwards."""
        if len(self.units) + len(missing) > KEPT:
            self.units = {u: self.units[u] for u in wanted if u in self.units}
        if len(self.cores) > KEPT:
            self.cores.clear()
        cores, split, asked = self.cores, [], set()
        for unit in missing:
            core = unit.rstrip(MARKS)
            last = core[-1:]
            if not (last.isalnum() and last <= "ɏ"):  # a run of marks that must stay whole
                core = unit
                if not unit or not _visible(unit[-1]):
                    continue
            if not ("!" <= unit[0] <= "~" or _visible(unit[0])):
                continue
            split.append((unit, core))
            if core not in cores:
                asked.add(core)
        listed = list(asked)
        for k in range(0, len(listed), 4096):
            part = listed[k : k + 4096]
            ids = np.frombuffer(self._whole(" " + " ".join(part)), self.dtype)
            ends = np.cumsum(self.width[ids])
            cuts = np.searchsorted(ends, np.cumsum([len(c.encode()) + 1 for c in part])) + 1
            raw, at = ids.tobytes(), 0
            for core, cut in zip(part, (cuts * self.dtype.itemsize).tolist()):
                self.cores[core] = raw[at:cut]
                at = cut
        units = self.units
        for unit, core in split:
            ids = cores[core]
            units[unit] = ids if len(core) == len(unit) else ids + self._tail(unit[len(core):])

    def _tail(self, marks: str) -> bytes:
        if marks not in self.tails:
            if len(self.tails) > KEPT:
                self.tails.clear()
            self.tails[marks] = self._whole(marks)
        return self.tails[marks]

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """The ids of each text; null is empty."""
        if not self.byte_level:
            return [np.frombuffer(self._whole(t), self.dtype) if t else np.empty(0, self.dtype)
                    for t in texts]
        added = [bool(t) and any(a in t for a in self.added) for t in texts]
        known = [not (marked or t and UNKNOWN.search(t)) for t, marked in zip(texts, added)]
        ids, pieces = self.pieces.__getitem__, PIECES.findall
        found = iter(self._by_units(
            [t for t, k in zip(texts, known) if not k], [a for a, k in zip(added, known) if not k]
        ))
        return [
            np.frombuffer(b"".join(map(ids, pieces(t or ""))), self.dtype) if k else next(found)
            for t, k in zip(texts, known)
        ]

    def _by_units(self, texts: list[str], added: list[bool]) -> list[np.ndarray]:
        """The ids of texts with unknown characters or with the string of an added token."""
        split = [t.split(" ") for t in texts]
        seen: set[str] = set()
        for units, marked in zip(split, added):
            if not marked:
                seen.update(units)
        if missing := seen.difference(self.units):
            self._learn(missing, seen)
        get, out = self.units.get, []
        for text, units, marked in zip(texts, split, added):
            first = units.pop(0)
            if marked or units and not (first and _visible(first[-1])):
                raw = self._whole(text)
            else:
                try:
                    raw = b"".join(map(get, units))
                except TypeError:  # a unit that cannot stand for itself
                    raw = self._whole(text)
                else:
                    raw = self._whole(first) + raw if first else raw
            out.append(np.frombuffer(raw, self.dtype))
        return out


@cache
def encoder(definition: str) -> Encoder:
    """One encoder to a worker and tokenizer, kept between tasks."""
    return Encoder(definition)
