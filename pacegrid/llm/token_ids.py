"""Token ids of whole texts under a byte-level BPE file."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken

# Fixed value: the word pattern of the byte-level vocabulary.
WORDS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# Fixed value: the white space of that pattern.
BLANKS = re.compile("[\\t-\\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")
#: The pattern's look-ahead steps back over white space one by one and gives up beyond a million.
LONG_BLANKS = 100_000


def byte_of_symbol() -> dict[str, int]:
    """The printable symbol that stands for each byte in byte-level vocabularies, inverted."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


def check_kind(described: dict) -> None:
    """Refuse a tokenizers file whose ids this module would get wrong.

    It must be byte-level BPE with the usual word pattern, without a normalizer, a prefix
    space or word ends, with added tokens that match as they stand, and with merges in the
    order of the ids that they make.
    """
    model, words = described["model"], described["pre_tokenizer"] or {}
    plain = {k: model.get(k) or None for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges", "byte_fallback")}
    if model.get("type", "BPE") != "BPE" or any(plain.values()) or described["normalizer"]:
        raise ValueError("not a plain byte-level BPE file")
    if words.get("type") != "ByteLevel" or words.get("add_prefix_space") or not words.get("use_regex", True):
        raise ValueError("words are not split by the byte-level pattern")
    if any(token["single_word"] or token["lstrip"] or token["rstrip"] or token["normalized"] for token in described["added_tokens"]):
        raise ValueError("added tokens match with conditions")
    pairs = (pair if isinstance(pair, list) else pair.split(" ") for pair in model["merges"])
    made = np.array([model["vocab"][left + right] for left, right in pairs])
    if (np.diff(made) <= 0).any() or (len(made) and made[0] < 256):
        raise ValueError("merges are not in the order of their ids")


@lru_cache(maxsize=2)
def encoding(path: str) -> tiktoken.Encoding:
    """The encoder of a tokenizers file; ids, merges and added tokens are those of the file.

    Merge order equals id order in such vocabularies, so the ids are the ranks.
    """
    with open(path, encoding="utf-8") as file:
        described = json.load(file)
    check_kind(described)
    added = {token["content"]: token["id"] for token in described["added_tokens"]}
    symbols = byte_of_symbol()
    ranks = {
        bytes(symbols[c] for c in token): number
        for token, number in described["model"]["vocab"].items()
        if token not in added
    }
    return tiktoken.Encoding("byte-bpe", pat_str=WORDS, mergeable_ranks=ranks, special_tokens=added)


def encoded(text: str, known: tiktoken.Encoding, special: bool = True) -> np.ndarray:
    """uint32 ids of a whole text; without `special`, strings of added tokens are plain text.

    A long run of white space is one word, but for its last character before other text that
    isn't an added token, which the next word may take. Such a run is cut out and encoded as the word it is, in
    linear time; what stands before it ends in other text, so its words stay the same.
    """
    allowed = "all" if special else set()
    added = tuple(known.special_tokens_set) if special else ()

    def part(piece: str) -> np.ndarray:
        return known.encode_to_numpy(piece, allowed_special=allowed, disallowed_special=())

    if len(text) < LONG_BLANKS:
        return part(text)
    done, found = 0, []
    for run in BLANKS.finditer(text):
        start, end = run.span()
        if end - start < LONG_BLANKS:
            continue
        word = end if end == len(text) or added and text.startswith(added, end) else end - 1
        found += [part(text[done:start]), np.array(known._encode_single_piece(text[start:word]), np.uint32)]
        done = word
    return np.concatenate([*found, part(text[done:])])


def ids_of(text: str | None, path: str, end_id: int) -> np.ndarray:
    """uint32 ids of a whole text and `end_id`; a null text is empty."""
    ids = encoded(text, encoding(path)) if text else np.empty(0, np.uint32)
    return np.append(ids, np.uint32(end_id)).astype("<u4", copy=False)


def each_document(batches: Iterator[pa.RecordBatch], path: str, end_id: int) -> Iterator[tuple[int | None, np.ndarray]]:
    """(id, token ids) of the rows of batches of (id, text)."""
    for batch in batches:
        for doc_id, text in zip(batch.column(0), batch.column(1)):
            yield doc_id.as_py(), ids_of(text.as_py(), path, end_id)
