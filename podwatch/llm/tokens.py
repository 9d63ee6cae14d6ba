"""Token ids of public tokenizers, piece by piece.

Both tokenizers cut a text into pieces before they look at their vocabulary, and no piece reaches over certain
places. Added tokens, such as special strings, are cut out before that. Texts are split at these, slice by slice.
A worker remembers the pieces it met lately, in two generations of bounded bytes (ids for one task, counts from task to task),
and misses are encoded in batches of equal bytes; words that need no cutting are so by the model alone. The result is the library's own, for every text.
"""

from __future__ import annotations

import os
import re
import sys
from array import array
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache
from typing import Any, NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

GENERATION_BYTES = 64 << 20  # a worker remembers pieces of twice as much
ENTRY_BYTES = 240  # of a piece in a worker's memory, with its value and besides its characters
BATCH_BYTES = 1 << 20
ROW_PIECES = 4096  # encoded in a row
JOINED_WORDS = 64  # of a row, merged as one piece
SLICE_CHARS = 256 << 10  # of text that is in pieces at a time
_SPACE = " \t\n\x0b\x0c\r\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_SPACE_SET = frozenset(map(chr, (9, 10, 11, 12, 13, 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))
# White space as the byte-level tokenizer's own splitter sees it: a word takes one space before it, and a
# run of white space leaves its last character to what follows.
_BYTE_LEVEL = re.compile(f" ?[^{_SPACE}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+")


# Places at which a piece always ends: before a space between two words, and where a letter meets a digit or a mark.
# Only characters that every version of the library's tables classes alike; an apostrophe is never on the left.
_ENDS = re.compile(
    f"(?<=[^{_SPACE}])(?= [^{_SPACE}])|(?<=[A-Za-z\u00c0-\u00d6\u0400-\u0481\u3041-\u3096\u30a1-\u30fa\u4e00-\u9fa5\uac00-\ud7a3])"
    "(?=[0-9.,;:!?\u3001\u3002\uff01\uff0c\uff1f])"
)


def slices(text: str, chars: int = SLICE_CHARS) -> Iterator[str]:
    """A text in slices of about ``chars`` characters whose pieces are those of the text. Without any such place it stays whole."""
    start = 0
    while len(text) - start > chars:
        end = _ENDS.search(text, start + chars)
        if end is None:
            break
        yield text[start : end.start()]
        start = end.start()
    yield text[start:] if start else text


# White space other than blanks and line ends.
_OTHER_SPACE = re.compile(f"[\t\x0b-\r{_SPACE[6:]}]")


def _marked(text: str) -> str | None:
    """The pieces of a slice joined by blanks, None if it has white space other than single blanks and line ends between words.

    Most pieces are words with one blank before them, which is left out. Others have a line end put before them, but line ends themselves.
    """
    inner = text[1:] if text[:1] == " " else text
    flat = inner.replace("\n", " ")
    # Printable text has no white space but blanks.
    if not flat or flat[0] == " " or flat[-1] == " " or "  " in flat or not flat.isprintable() and _OTHER_SPACE.search(flat):
        return None
    return ("\n" if inner is text else "") + inner.replace("\n", " \n \n")


def _unmarked(piece: str) -> str | bytes:
    return piece if piece[0] != "\n" else piece[1:].encode() or b"\n"


def _cut(text: str) -> list[str | bytes]:
    """Pieces of a slice that can not be marked: a str is a word with one blank before it, which is left out; bytes are anything else, as it is."""
    return [p[1:] if len(p) > 1 and p[0] == " " and p[1] not in _SPACE_SET else p.encode() for p in _BYTE_LEVEL.findall(text)]


def byte_level_slices(text: str, added: AddedTokens | None = None) -> Iterator[str | list[str | bytes]]:
    """Slices of a text for a byte-level tokenizer whose splitter is on, marked if they can be and else in pieces; ``added``: its added
    tokens, between which each segment is cut by itself."""
    segments: list[str | list[str | bytes]] = [text]
    if added is not None and added.strings and added.strings.search(text):
        if not added.plain:
            yield [text.encode()]
            return
        # Every second one is an added token.
        segments = [[x.encode()] if k % 2 else x for k, x in enumerate(added.strings.split(text))]
    for segment in segments:
        if isinstance(segment, list):
            yield segment
            continue
        for part in slices(segment):
            marked = _marked(part)
            yield _cut(part) if marked is None else marked


def byte_level_pieces(text: str, added: AddedTokens | None = None) -> Iterator[list[str | bytes]]:
    """Pieces of a byte-level tokenizer, slice by slice. A str is a word with one blank before it, which is left out; bytes are anything else, as it is."""
    for part in byte_level_slices(text, added):
        yield list(map(_unmarked, part.split(" "))) if isinstance(part, str) else part


def ids_of_slices(known: Pieces, parts: list[str | list[str | bytes]]) -> list[np.ndarray]:
    """The ids of each of some slices. Pieces of marked ones are told apart and numbered by Arrow, so that each is looked up once."""
    marked = pc.split_pattern(pa.array([x for x in parts if isinstance(x, str)], pa.large_string()), " ")
    pieces = marked.values.dictionary_encode()
    values = known.of_distinct(list(map(_unmarked, pieces.dictionary.to_numpy(zero_copy_only=False).tolist())))
    each = pa.array(values, pa.large_binary()).take(pieces.indices)
    _, offsets, data = each.buffers()
    ends = np.frombuffer(offsets, dtype=np.int64, count=len(each) + 1) // 4 if len(each) else np.zeros(1, dtype=np.int64)
    ids = np.frombuffer(data or b"", dtype="<u4", count=ends[-1])
    cuts = ends[marked.offsets.to_numpy()]
    found = iter(ids[x:y] for x, y in zip(cuts, cuts[1:], strict=False))
    return [next(found) if isinstance(x, str) else np.frombuffer(b"".join(known.of(x)), dtype="<u4") for x in parts]


def word_pieces(text: str) -> list[bytes]:
    """Pieces of a tokenizer that drops white space: what stands between ASCII white space."""
    return text.encode().split()


@lru_cache(maxsize=4)
def tokenizer(path: str) -> Any:
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(path)
    found.no_truncation()
    found.no_padding()
    return found


class AddedTokens(NamedTuple):
    """Strings that the library cuts out of a text first; ``plain`` if they match as they are, whatever stands beside them."""

    strings: re.Pattern[str] | None
    plain: bool


@lru_cache(maxsize=4)
def added_tokens(path: str) -> AddedTokens:
    found = tokenizer(path)
    tokens = list(found.get_added_tokens_decoder().values())
    plain = not any(t.single_word or t.lstrip or t.rstrip or t.normalized and found.normalizer for t in tokens)
    # The first of all in the text, and of those at one place the longest.
    strings = sorted({t.content for t in tokens if t.content}, key=len, reverse=True)
    return AddedTokens(re.compile(f"({'|'.join(map(re.escape, strings))})") if strings else None, plain)


def batches_by_bytes(pieces: Iterable[Any]) -> Iterator[list[Any]]:
    batch, size = [], 0
    for piece in pieces:
        batch.append(piece)
        size += len(piece)
        if size >= BATCH_BYTES:
            yield batch
            batch, size = [], 0
    if batch:
        yield batch


def packed_ids(ids: list[int]) -> bytes:
    """Ids as little-endian unsigned 32-bit numbers."""
    found = array("I", ids)
    if sys.byteorder == "big":
        found.byteswap()
    return found.tobytes()


@lru_cache(maxsize=2)
def count_pieces(path: str) -> Pieces:
    """Token counts of pieces, shared by all tasks of a worker."""
    return Pieces(path, _counts)


def id_pieces(path: str) -> Pieces:
    """Packed ids of pieces of a byte-level tokenizer, for one task.

    Spark deals tasks to more workers than run at a time, and what each kept would add up; a task meets its common pieces again soon.
    """
    return Pieces(path, _ids)


def _counts(path: str, pieces: list[bytes], into: dict[Any, Any]) -> None:
    for batch in batches_by_bytes(pieces):
        into.update(zip(batch, map(len, tokenizer(path).encode_batch_fast([p.decode() for p in batch], add_special_tokens=False)), strict=True))


@lru_cache(maxsize=2)
def _token_bytes(path: str) -> np.ndarray | None:
    """Bytes that each id stands for; a byte-level vocabulary writes one character a byte. None if an added token has a space."""
    found = tokenizer(path)
    if any(" " in t.content for t in found.get_added_tokens_decoder().values()):
        return None
    sizes = np.zeros(found.get_vocab_size(), dtype=np.int64)
    for token, i in found.get_vocab(with_added_tokens=False).items():
        sizes[i] = len(token)
    return sizes


# Words of characters that every version of the library's tables classes alike. None has an apostrophe, which may begin a piece of letters.
_PLAIN = re.compile("[!-&(-~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u017f\u0400-\u0481]+")
# Tokens that reach over a border between pieces of plain words, as a byte-level vocabulary writes them: a blank is U+0120, bytes from
# 0x80 to 0xbf are those of _LATER, and what begins the letters beyond ASCII is in _LEAD.
_MARK, _LEAD, _LATER = r"!-&(-/:-@\[-`{-~", "\u00c3-\u00c5\u00d0-\u00d2", "\u00a1-\u00ac\u00ae-\u00bf\u0122-\u0143"
_OVER = re.compile(
    f"[A-Za-z][0-9{_MARK}\u0120]|[0-9][A-Za-z{_MARK}{_LEAD}\u0120]|[{_MARK}][A-Za-z0-9{_LEAD}\u0120]|(?:^|[{_LEAD}])[{_LATER}][0-9{_MARK}\u0120]"
)


@lru_cache(maxsize=2)
def uncut(path: str) -> Any:
    """The tokenizer with the same model but without its splitter, which takes most of its time. None if plain words may need the splitter:
    merges make no token over a border if the vocabulary has none."""
    from tokenizers import Tokenizer
    from tokenizers.models import BPE
    from tokenizers.pre_tokenizers import ByteLevel

    found = tokenizer(path)
    model, splitter = found.model, found.pre_tokenizer
    if found.normalizer or not isinstance(splitter, ByteLevel) or not splitter.use_regex or not isinstance(model, BPE):
        return None
    if model.dropout or model.ignore_merges or model.continuing_subword_prefix or model.end_of_word_suffix:
        return None
    if any(map(_OVER.search, found.get_vocab(with_added_tokens=False))):
        return None
    whole = Tokenizer(model)
    whole.pre_tokenizer = ByteLevel(add_prefix_space=False, use_regex=False)
    return whole


def _ids(path: str, pieces: list[str | bytes], into: dict[Any, Any]) -> None:
    """Packed ids of each piece. Words are encoded in a row, as the tokenizer begins anew at each blank before one."""
    sizes, whole = _token_bytes(path), uncut(path)
    words = [p for p in pieces if type(p) is str]
    others = [p for p in pieces if type(p) is bytes]
    if sizes is None:
        words, others = [], pieces
    plain = list(filter(_PLAIN.fullmatch, words)) if whole else []
    if len(plain) == len(words):
        words = []
    elif plain:
        words = [w for w in words if not _PLAIN.fullmatch(w)]
    rows = [(whole, JOINED_WORDS, plain[k : k + ROW_PIECES]) for k in range(0, len(plain), ROW_PIECES)]
    rows += [(tokenizer(path), ROW_PIECES, words[k : k + ROW_PIECES]) for k in range(0, len(words), ROW_PIECES)]
    strings = added_tokens(path).strings
    for encoder, joined, row in rows:
        texts = [" " + " ".join(row[k : k + joined]) for k in range(0, len(row), joined)]
        text = "".join(texts)
        if strings and strings.search(text):
            others += row
            continue
        encoded = encoder.encode_batch_fast(texts, add_special_tokens=False)
        ids = np.array([i for x in encoded for i in x.ids], dtype="<u4")
        ends = np.cumsum(sizes[ids])
        until = np.append(np.flatnonzero(np.frombuffer(text.encode(), dtype=np.uint8)[1:] == ord(" ")) + 1, len(text.encode()))
        at = np.searchsorted(ends, until)
        if at[-1] < len(ends) and np.array_equal(ends[at], until):
            raw, cuts = ids.tobytes(), [0, *((at + 1) * 4).tolist()]
            into.update(zip(row, map(raw.__getitem__, map(slice, cuts, cuts[1:])), strict=True))
        else:
            others += row
    for batch in batches_by_bytes(others):
        texts = [p.decode() if type(p) is bytes else " " + p for p in batch]
        into.update(zip(batch, (packed_ids(x.ids) for x in tokenizer(path).encode_batch_fast(texts, add_special_tokens=False)), strict=True))


class Pieces:
    """What ``encode`` makes of pieces, remembered while they keep coming; it puts the value of each piece into a table.

    A generation ends when it has GENERATION_BYTES; what is met again in the next moves there, the rest goes with the one after.
    """

    def __init__(self, path: str, encode: Callable[[str, list[Any], dict[Any, Any]], None]) -> None:
        self.path, self.encode = path, encode
        self.young: dict[Any, Any] = {}
        self.old: dict[Any, Any] = {}
        self.bytes = 0

    def of(self, pieces: list[Any]) -> list[Any]:
        """The value of each piece, in order."""
        # A slice repeats most of its pieces: each is looked for once in the large tables, and its repeats in a small one.
        found = dict.fromkeys(pieces)
        found = dict(zip(found, self.of_distinct(list(found)), strict=True))
        return list(map(found.__getitem__, pieces))

    def of_distinct(self, pieces: list[Any]) -> list[Any]:
        """The value of each piece, in order; no two are equal."""
        if self.bytes >= GENERATION_BYTES:
            self.old, self.young, self.bytes = self.young, {}, 0
        young, old = self.young, self.old
        values = list(map(young.get, pieces))
        places = [k for k, value in enumerate(values) if value is None]
        if places:
            absent = [pieces[k] for k in places]
            made = {p: value for p, value in zip(absent, map(old.get, absent), strict=True) if value is not None}
            self.encode(self.path, [p for p in absent if p not in made], made)
            self.bytes += ENTRY_BYTES * len(absent) + sum(map(len, absent))
            for k, value in zip(places, map(made.__getitem__, absent), strict=True):
                values[k] = value
            young.update(made)
        return values
