"""Packing by power-of-two decomposition: sequences that never cross documents.

A document's token ids, with an end id behind them, are cut into as many
pieces of the longest length as fit and then into one piece for every bit of
what is left, longest first. Every piece has a power of two of tokens and is a
sequence of its own, so nothing is padded and no sequence holds two documents.
Pieces of equal length share a bucket, and a training job draws its batches
from one bucket at a time.

Ids are those of the `tokenizers` library for the given vocabulary file, with
special tokens' strings taken as ordinary text. Where the file's merges are in
the order of its ids, as byte-level vocabularies are, texts of characters up to
U+024F are encoded by `tiktoken` from the very same file, which gives the same
ids (tests compare both) in a quarter of the time; other texts go to
`tokenizers` itself. Texts are encoded in blocks, cut before a single blank or
line end between two visible characters, where no token can reach across.

A sequence's number is its bucket, the number of its partition and its place
there, so one pass over the texts is all there is: no shuffle and no counts.
Over stored tables, whose rows keep their order, a task that runs again gives
its sequences the same numbers; over rows from a shuffle numbers are unique,
but may be dealt differently.

Defined cases: a null text counts as empty and gives one piece that holds the
end id alone; a null doc_id stays null; repeated rows are packed as often as
they stand; of a very long text all ids are held at once, and what the encoder
needs for a block, which is longer only where no cut is found; an empty table
gives an empty result.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_rows

VOCABULARY = "byte_bpe_50k.json"
END_ID = 1
LONGEST = 2048
BLOCK_CHARS = 1 << 18
PLACE_BITS, PART_BITS = 28, 31

SEAM = re.compile("(?<=[^\\s\u180e\u200b])[ \n](?=[^\\s\u180e\u200b])")
FAR = re.compile("[^\\x00-\u024f]")
# Fixed value: how byte-level vocabularies of this family split a text before merging.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

Encoder = Callable[[str], np.ndarray]


def vocabulary_path(vocabulary: str) -> str:
    """A path as it is, a bare name as a file of the installed vocabularies."""
    if "/" in vocabulary:
        return vocabulary
    import public_tokenizers

    return public_tokenizers.path(vocabulary)


@cache
def encoder(vocabulary: str = VOCABULARY) -> Encoder:
    """Ids of a text as an array, one encoder for each worker process and file."""
    from tokenizers import Tokenizer

    path = vocabulary_path(vocabulary)
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    ranked = _ranked(path)

    def block_ids(block: str) -> np.ndarray:
        if ranked is not None and not FAR.search(block):
            try:
                return ranked.encode_to_numpy(block, disallowed_special=())
            except ValueError:  # its pattern gives up on millions of blanks in a row
                pass
        return np.array(tokenizer.encode_batch_fast([block], add_special_tokens=False)[0].ids, np.uint32)

    def ids(text: str) -> np.ndarray:
        found = [block_ids(block) for block in blocks(text)]
        return found[0] if len(found) == 1 else np.concatenate(found) if found else np.zeros(0, np.uint32)

    return ids


def _ranked(path: str):
    """The vocabulary as ranks, None where its ids don't give the order of its merges or its split is another."""
    import tiktoken

    with open(path, encoding="utf-8") as file:
        held = json.load(file)
    model, before = held["model"], held.get("pre_tokenizer") or {}
    plain = not held.get("normalizer") and not model.get("continuing_subword_prefix") and not model.get("end_of_word_suffix")
    if not plain or before.get("type") != "ByteLevel" or before.get("add_prefix_space") or not before.get("use_regex", True):
        return None
    special = {t["content"] for t in held["added_tokens"]}
    letters = _byte_letters()
    ranks = {bytes(letters[c] for c in token): k for token, k in model["vocab"].items() if token not in special}
    pairs = (m if isinstance(m, list) else m.split(" ") for m in model["merges"])
    merged = [model["vocab"]["".join(pair)] for pair in pairs]
    single = [k for token, k in ranks.items() if len(token) == 1]
    if len(single) != 256 or merged != sorted(merged) or max(single) >= min(merged) or len(ranks) != 256 + len(merged):
        return None
    return tiktoken.Encoding("ranked", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})


def _byte_letters() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for: itself if visible, else the next letter from U+0100."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = sorted(set(range(256)) - set(visible))
    return {chr(b): b for b in visible} | {chr(0x100 + k): b for k, b in enumerate(hidden)}


def blocks(text: str, size: int = BLOCK_CHARS) -> Iterator[str]:
    """The text in blocks of about `size`, cut only where no token can reach across."""
    at = 0
    while len(text) - at > size:
        seam = SEAM.search(text, at + size)
        if seam is None:
            break
        yield text[at : seam.start()]
        at = seam.start()
    if at < len(text):
        yield text[at:]


def lengths(count: int, longest: int = LONGEST) -> list[int]:
    """The pieces of `count` tokens: longest ones as often as they fit, then the powers of two in the rest."""
    rest = count % longest
    return [longest] * (count // longest) + [1 << k for k in range(longest.bit_length() - 1, -1, -1) if rest >> k & 1]


PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, bucket int"


def decomposed(
    docs: DataFrame, vocabulary: str = VOCABULARY, longest: int = LONGEST, end_id: int = END_ID, with_ids: bool = True
) -> DataFrame:
    """One row per piece, with its ids where asked for.

    `longest` is a power of two; `vocabulary` a path that every executor has,
    or the name of an installed file.
    """
    if longest < 1 or longest & (longest - 1):
        raise ValueError("longest must be a power of two")

    def apply(rows: Iterator[tuple]) -> Iterator[list]:
        encode, part = encoder(vocabulary), TaskContext.get().partitionId()
        next_place = [0] * longest.bit_length()
        out: list[tuple] = []
        held = 0
        for doc_id, text in rows:
            ids = np.append(encode(text or ""), np.uint32(end_id)).astype("<u4")
            start = 0
            for length in lengths(len(ids), longest):
                bucket = length.bit_length() - 1
                place = next_place[bucket]
                next_place[bucket] += 1
                if place >> PLACE_BITS:
                    raise OverflowError("a partition has too many sequences: use more partitions")
                piece = ids[start : start + length]
                number = (bucket << (PART_BITS + PLACE_BITS)) | (part << PLACE_BITS) | place
                row = (doc_id, start, length, zlib.crc32(piece.tobytes()), len(ids), number, 0, bucket)
                out.append((*row, piece) if with_ids else row)
                start += length
                held += length if with_ids else 32
                if held >= 1 << 20:
                    yield [list(c) for c in zip(*out, strict=True)]
                    out, held = [], 0
        if out:
            yield [list(c) for c in zip(*out, strict=True)]

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return map_rows(rows, apply, PIECES + (", ids array<int>" if with_ids else ""))


def write_buckets(pieces: DataFrame, path: str) -> None:
    """The sequences stored by length, one folder for each bucket."""
    pieces.write.partitionBy("bucket").parquet(path)
