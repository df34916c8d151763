"""Exact token ids, each distinct piece between which no token can lie encoded once a batch."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable
from functools import lru_cache
from itertools import chain, pairwise
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Pieces that a worker remembers the library's answer for, and the characters of the longest of them.
CACHE, LONGEST = 100_000, 64
#: A space with white space beside it belongs to that run, so a text may not be cut there.
_RUN = re.compile(r" \s|\s ")
_LATIN = re.compile(r"([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+)([!-&(-/:-@\[-`{-~]*)")
_WIDE = re.compile(r"[^\x00-\xff]")
#: The byte that each character of a byte-level vocabulary stands for: printable Latin-1 characters for
#: themselves, the other bytes in order for the characters from 256.
_PRINTABLE = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_BYTES = {chr(b): b for b in _PRINTABLE} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in set(_PRINTABLE))}
#: Bytes of UTF-8 letters inside a word, and what stands for a word's last byte.
_INNER = {*range(ord("a"), ord("z") + 1), *range(0x80, 0x100)}
_FINAL = {b: bytes([k]) for k, b in enumerate([*range(ord("a"), ord("z") + 1), *range(0x80, 0xC0)])}


def version_digest(path: str) -> str:
    """What identifies a tokenizer: SHA-256 of its file."""
    return hashlib.sha256(Path(path).read_bytes()).hexdigest()


def _word_bpe(vocabulary: dict[str, int]) -> Callable[[bytes], list[int]]:
    """Byte pair merges of one word of letters, its last byte replaced by _FINAL's.

    A vocabulary of words marks last symbols with </w>. Here a last byte has a value of its own, so
    merges of bytes by rank give the same tokens: an id is 512 and the merge's place in the list.
    """
    import tiktoken

    ranks: dict[bytes, int] = {}
    for x, i in vocabulary.items():
        raw = bytes(_BYTES[c] for c in x.removesuffix("</w>"))
        word = raw[:-1] + _FINAL.get(raw[-1], b"") if x.endswith("</w>") else raw
        if len(word) == len(raw) and all(c in _INNER for c in raw[:-1]) and (x.endswith("</w>") or raw[-1] in _INNER):
            ranks[word] = i
    return tiktoken.Encoding("words", pat_str=r"\S+", mergeable_ranks=ranks, special_tokens={})._core_bpe.encode_single_piece


def word_encoder(path: str) -> Callable[[list[str]], list[bytes]]:
    """Ids (little-endian, 32 bits) of texts for a vocabulary that drops white space, lowers case and
    marks the last token of each run of letters or signs with </w>.

    Texts are cut at spaces and newlines, rarer white space is left to the library; each distinct
    piece of the batch is encoded once and nothing is kept but the library's latest pieces. Words of
    Latin-1 letters, which the normaliser would only lower, are merged by rank; all else goes through
    the library. Special tokens must hold no white space.
    """
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    merge = _word_bpe(t.get_vocab(with_added_tokens=False))
    special = [x.content for x in t.get_added_tokens_decoder().values()]
    encode = lambda x: t.encode(x, add_special_tokens=False).ids
    short = lru_cache(CACHE)(encode)
    library = lambda x: short(x) if len(x) <= LONGEST else encode(x)

    def lowered(text: str) -> str:
        low = text if _WIDE.search(text) else text.lower()
        return text if any(x in low for x in special) else low

    def piece(p: str) -> list[int]:
        found = _LATIN.fullmatch(p)
        if not found:
            return library(p) if p else []
        word = found[1].lower().encode()
        ids = merge(word[:-1] + _FINAL[word[-1]])
        return ids + library(found[2]) if found[2] else ids

    def run(texts: list[str]) -> list[bytes]:
        whole = pc.replace_substring(pa.array([lowered(x) for x in texts], pa.large_string()), "\n", " ")
        parts = pc.split_pattern(whole, " ")
        flat, ends = parts.flatten().dictionary_encode(), parts.offsets.to_numpy() - parts.offsets[0].as_py()
        del whole, parts
        ids = [piece(p) for p in flat.dictionary.to_pylist()]
        size = np.fromiter(map(len, ids), np.int64, len(ids))
        known, start = np.fromiter(chain.from_iterable(ids), "<u4", int(size.sum())), np.cumsum(size) - size
        del ids
        which = flat.indices.to_numpy()
        n = size[which]
        after = np.cumsum(n)
        at = np.repeat(start[which] - after + n, n)
        at += np.arange(len(at))
        raw = known[at].tobytes()
        ends = 4 * np.append(0, after)[ends]
        return [raw[a:b] for a, b in pairwise(ends.tolist())]

    return run


def counter(path: str) -> Callable[[list[str]], list[int]]:
    """Numbers of tokens of texts, without begin, end or added special tokens.

    .json: a byte-level vocabulary, whose pieces may start with one space; a text is cut before
    each space that has no other white space beside it, which no token of such a vocabulary
    crosses. Each distinct piece of the batch is counted once: letters by merges of their bytes,
    a single newline between two words is a token of its own, all else goes through the library.
    .model: sentencepiece, whole texts.
    """
    if path.endswith(".model"):
        import sentencepiece

        p = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda texts: [len(x) for x in p.encode(texts, num_threads=1)]
    import tiktoken
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    ranks = {bytes(_BYTES[c] for c in x): i for x, i in t.get_vocab(with_added_tokens=False).items() if all(c in _BYTES for c in x)}
    merge = tiktoken.Encoding("bytes", pat_str=r"\S+", mergeable_ranks=ranks, special_tokens={})._core_bpe.encode_single_piece
    size = lambda x: len(t.encode(x, add_special_tokens=False).ids)
    short = lru_cache(CACHE)(size)
    library = lambda x: short(x) if len(x) <= LONGEST else size(x)
    newline = library("\n")

    def piece(p: str, before: str) -> int:
        """Tokens of a piece with `before`, a space or nothing, in front of it."""
        found = _LATIN.fullmatch(p)
        if found:
            return len(merge((before + found[1]).encode())) + (library(found[2]) if found[2] else 0)
        lines = p.split("\n")
        if len(lines) > 1 and all(map(_LATIN.fullmatch, lines)):
            return piece(lines[0], before) + sum(newline + piece(x, "") for x in lines[1:])
        return library(before + p) if before or p else 0

    def spaced(texts: list[str]) -> list[int]:
        parts = pc.split_pattern(pa.array(texts, pa.large_string()), " ")
        flat = parts.flatten().dictionary_encode()
        n = np.array([piece(p, " ") for p in flat.dictionary.to_pylist()], np.int64)[flat.indices.to_numpy()]
        sums, at = np.append(0, np.cumsum(n)), parts.offsets.to_numpy() - parts.offsets[0].as_py()
        n_first = [piece(x.partition(" ")[0], "") for x in texts]
        return (sums[at[1:]] - sums[at[:-1]] - n[at[:-1]] + np.array(n_first, np.int64)).tolist()

    def with_runs(text: str) -> int:
        at = [0, *[m.start() for m in re.finditer(r"(?<=\S) (?=\S)", text)], len(text)]
        return sum(piece(x[1:], " ") if x.startswith(" ") else piece(x, "") for x in (text[a:b] for a, b in pairwise(at)))

    def run(texts: list[str]) -> list[int]:
        runs = [bool(_RUN.search(x)) for x in texts]
        plain = iter(spaced([x for x, r in zip(texts, runs, strict=True) if not r]))
        return [with_runs(x) if r else next(plain) for x, r in zip(texts, runs, strict=True)]

    return run
