"""Token ids of whole texts from a tokenizers file, with each distinct unit encoded once.

A unit is a run of white space with the word behind it. Neither vocabulary's pre-tokenizer joins text across the end
of a word, so a text's ids are its units' ids in a row. Only blank, tab and line ends divide units; a text with other
white space, where that could differ, is encoded whole.
"""

from __future__ import annotations

import json
import re
import struct

import numpy as np

from .common import keep

#: Characters of kept units and pre-tokens together; then both stores start anew. Longer ones than KEPT_UNIT aren't kept.
KEPT, KEPT_UNIT = 8_000_000, 64
OTHER_SPACE = re.compile("[\x0b\x0c\x1c-\x1f\x85\xa0  -     　]")


#: Units of these characters alone need no normalizer, and one expression finds their pre-tokens; others take the library's whole way.
SIMPLE = re.compile(r"[ ]?[!#-&(-;=?-~A-Za-z0-9À-ÖØ-öø-ÿ]+").fullmatch
#: Texts of simple units and dividing white space alone; where white space is dropped, one expression finds all their pre-tokens.
PLAIN = re.compile(r"[ \n\r\t!#-&(-;=?-~A-Za-z0-9À-ÖØ-öø-ÿ]*").fullmatch
#: The two files' pre-tokens of simple units: white space counts (digits run on), or it doesn't (each digit alone).
SPACED = re.compile(r" ?[A-Za-zÀ-ÖØ-öø-ÿ]+| ?[0-9]+| ?[^ A-Za-z0-9À-ÖØ-öø-ÿ]+").findall
BARE = re.compile(r"[A-Za-zÀ-ÖØ-öø-ÿ]+|[0-9]|[^ \n\r\tA-Za-z0-9À-ÖØ-öø-ÿ]+").findall


def byte_letters() -> dict[int, str]:
    """Byte-level alphabet: printable bytes stand for themselves, the others for what follows 255 in order."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    others = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(others)}


def checked(path: str, spaces_count: bool):
    """The library's tokenizer of a file whose pre-tokens are those that this module knows; ValueError for others."""
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(path)
    library.no_truncation()
    library.no_padding()
    own = json.loads(library.to_str())
    kinds = lambda x, inner: [y["type"] for y in x[inner]] if x and x["type"] == "Sequence" else [x["type"]] if x else []
    have = (kinds(own["normalizer"], "normalizers"), kinds(own["pre_tokenizer"], "pretokenizers"), own["model"]["type"])
    want = ([], ["ByteLevel"], "BPE") if spaces_count else (["NFC", "Replace", "Lowercase"], ["Split", "ByteLevel"], "BPE")
    if have != want or (spaces_count and (own["pre_tokenizer"]["add_prefix_space"] or not own["pre_tokenizer"]["use_regex"])):
        raise ValueError(f"{path}: its normalizer, pre-tokenizer or model is not one that units are known for: {have}")
    return library


class Store(dict):
    """Ids of units or of pre-tokens; one that isn't here is found by ``find``, without a second look at the text's others."""

    def __init__(self, find):
        super().__init__()
        self.find = find

    def __missing__(self, unit: str) -> bytes:
        return self.find(unit)


class UnitEncoder:
    """Encodes by the library, remembering units and pre-tokens."""

    def __init__(self, path: str, spaces_count: bool):
        self.library = checked(path, spaces_count)
        self.model, self.letters = self.library.model, byte_letters()
        self.known, self.parts, self.size = Store(self.unit), Store(self.part), 0
        self.spaces_count = spaces_count
        #: Where white space is dropped, units need not carry it.
        self.split = re.compile(r"[ \n\r\t]*[^ \n\r\t]+|[ \n\r\t]+").findall if spaces_count else str.split

    def ids(self, text: str) -> list[int]:
        return self.library.encode(text, add_special_tokens=False).ids

    def part(self, pretoken: str) -> bytes:
        # printable ASCII stands for itself
        letters = pretoken if pretoken.isascii() and pretoken[0] != " " else pretoken.encode().decode("latin-1").translate(self.letters)
        coded = [t.id for t in self.model.tokenize(letters)]
        found = struct.pack(f"<{len(coded)}I", *coded)
        if len(pretoken) <= KEPT_UNIT:
            self._keep(self.parts, pretoken, found)
        return found

    def _keep(self, store: Store, key: str, value: bytes) -> None:
        self.size += len(key) + 16
        if self.size > KEPT:
            self.known.clear()
            self.parts.clear()
            self.size = len(key) + 16
        store[key] = value

    def unit(self, unit: str) -> bytes:
        if not SIMPLE(unit):
            found = np.array(self.ids(unit), "<u4").tobytes()
        else:
            found = b"".join(map(self.parts.__getitem__, SPACED(unit) if self.spaces_count else BARE(unit.lower())))
        if len(unit) <= KEPT_UNIT:
            self._keep(self.known, unit, found)
        return found

    def units(self, text: str) -> list[str]:
        return [text] if OTHER_SPACE.search(text) else self.split(text)

    def packed(self, text: str) -> bytes:
        """All ids of a text as little-endian unsigned 32-bit numbers."""
        if not self.spaces_count and PLAIN(text):
            return b"".join(map(self.parts.__getitem__, BARE(text.lower())))
        return b"".join(map(self.known.__getitem__, self.units(text)))


def encoder(path: str, spaces_count: bool) -> UnitEncoder:
    """One for each Python worker; its units outlast a task, but not the stage (``common.let_go``)."""
    return keep((path, spaces_count), lambda: UnitEncoder(path, spaces_count))
