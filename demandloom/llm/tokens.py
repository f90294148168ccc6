"""Token ids of texts by a public tokenizer file, in Arrow batches.

The tokenizer drops white space and never joins across it, so a text's ids are those of its
white-space separated chunks, one after another. Each distinct chunk of a batch goes through the
tokenizers library once; a worker keeps what it has seen, up to a bound, in arrays. Chunks of plain
letters, digits and signs need none of the tokenizer's normalising and splitting by patterns: they
go to the library with the same model, divided by Arrow, where the file says how it divides.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Chunks a worker remembers, and ids for each of them on average; beyond, it keeps those it met again.
REMEMBERED, IDS_EACH = 1_000_000, 8
#: New chunks that go to the library as one text, and such texts in one call.
TOGETHER, TEXTS = 200, 64
#: Bytes of text handled at a time.
SLICE_BYTES = 8_000_000

#: Chunks of letters that no normalising changes, digits and signs, and the pieces they are divided in.
_LETTERS, _SIGNS = "a-z\u00df-\u00f6\u00f8-\u00ff", r"!-&(-/:-@\[-`{-~"
PLAIN = f"^[{_LETTERS}0-9{_SIGNS}]+$"
PIECE = f"([{_LETTERS}]+|[0-9]|[{_SIGNS}]+)"

_NORMALIZER = {
    "type": "Sequence",
    "normalizers": [
        {"type": "NFC"},
        {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "},
        {"type": "Lowercase"},
    ],
}
_BYTES = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}
_SPLIT = {
    "type": "Split",
    "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"},
    "behavior": "Removed",
    "invert": True,
}
_MODEL = {
    "type": "BPE", "dropout": None, "unk_token": None, "continuing_subword_prefix": None,
    "end_of_word_suffix": "</w>", "fuse_unk": False, "byte_fallback": False, "ignore_merges": False,
}


@lru_cache(maxsize=4)
def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@lru_cache(maxsize=4)
def _ignores_case(path: str) -> bool:
    """True if the tokenizer gives capitals A-Z the ids of small letters."""
    one = lambda c: _tokenizer(path).encode(c, add_special_tokens=False).ids
    return all(one(chr(c)) == one(chr(c + 32)) for c in range(65, 91))


@lru_cache(maxsize=4)
def _divider(path: str) -> tuple[str, int] | None:
    """A special token and its id that divides chunks: ids beside it are those of the chunks alone."""
    tokenizer = _tokenizer(path)
    special = {t.content: i for i, t in tokenizer.get_added_tokens_decoder().items()}
    if not special or not all(t.startswith("<|") for t in special):
        return None
    ids = lambda t: tokenizer.encode(t, add_special_tokens=False).ids
    text, number = min(special.items())
    alone = [ids("a"), [number], ids("7"), [number], ids("<")]
    return (text, number) if ids(f"a{text}7{text}<") == sum(alone, []) else None


@lru_cache(maxsize=4)
def _plain(path: str):
    """The tokenizer for plain chunks cut at spaces, and for each id whether it ends a piece.

    None unless the file normalises, divides and marks the ends of pieces as ``PIECE`` relies on.
    """
    from tokenizers import Tokenizer, pre_tokenizers

    with open(path, encoding="utf-8") as file:
        told = json.load(file)
    model = dict(told["model"])
    vocab, _ = model.pop("vocab"), model.pop("merges")
    symbols = pre_tokenizers.ByteLevel.alphabet()
    if (
        told["normalizer"] != _NORMALIZER
        or told["pre_tokenizer"] != {"type": "Sequence", "pretokenizers": [_SPLIT, _BYTES]}
        or model != _MODEL
        or not all(t["content"].startswith("<|") for t in told["added_tokens"])
        or not all(c in vocab and f"{c}</w>" in vocab for c in symbols)
    ):
        return None
    bare = {"type": "Sequence", "pretokenizers": [{"type": "WhitespaceSplit"}, _BYTES]}
    told |= {"normalizer": None, "pre_tokenizer": bare, "added_tokens": []}
    ends = np.zeros(max(vocab.values()) + 1, bool)
    ends[[i for t, i in vocab.items() if t.endswith("</w>")]] = True
    return Tokenizer.from_str(json.dumps(told)), ends


def _encoded(tokenizer, texts: list[str]) -> Iterator[np.ndarray]:
    """Ids of each text; few texts are in the library at a time."""
    for i in range(0, len(texts), TEXTS):
        for found in tokenizer.encode_batch_fast(texts[i : i + TEXTS], add_special_tokens=False):
            yield np.asarray(found.ids, np.uint32)


def encode_chunks(chunks: list[str], path: str) -> list[bytes]:
    """Ids (uint32) of each chunk. Chunks go to the library by the hundred, with a divider between."""
    tokenizer, divider = _tokenizer(path), _divider(path)

    def one_by_one(some: list[str]) -> list[bytes]:
        return [ids.tobytes() for ids in _encoded(tokenizer, some)]

    if divider is None or any("<|" in c for c in chunks):
        return one_by_one(chunks)
    text, number = divider
    groups = [chunks[i : i + TOGETHER] for i in range(0, len(chunks), TOGETHER)]
    out: list[bytes] = []
    for group, ids in zip(groups, _encoded(tokenizer, [text.join(g) for g in groups])):
        ends = np.append(np.flatnonzero(ids == number), len(ids))
        if len(ends) != len(group):
            out += one_by_one(group)
            continue
        raw = ids.tobytes()
        begins = np.append(0, ends[:-1] + 1)
        out += [raw[4 * a : 4 * b] for a, b in zip(begins.tolist(), ends.tolist())]
    return out


def encode_plain(chunks: pa.Array, path: str) -> tuple[np.ndarray, np.ndarray]:
    """``ids`` of chunks that match ``PLAIN`` and hold no special token, and how many each has."""
    tokenizer, end_of_piece = _plain(path)
    if not len(chunks):
        return np.zeros(0, np.uint32), np.zeros(0, np.int64)
    spaced = pc.replace_substring_regex(chunks, PIECE, r"\1 ")
    pieces = np.asarray(pc.count_substring(spaced, " "), dtype=np.int64)
    cuts = np.append(np.arange(0, len(chunks), TOGETHER), len(chunks)).astype(np.int32)
    texts = pc.binary_join(pa.ListArray.from_arrays(cuts, spaced), "").to_pylist()
    ids = np.concatenate(list(_encoded(tokenizer, texts)))
    ends = np.flatnonzero(end_of_piece[ids]) + 1
    assert len(ends) == pieces.sum(), "each piece ends with one token that says so"
    return ids, np.diff(ends[np.cumsum(pieces) - 1], prepend=0)


def encode_distinct(chunks: pa.Array, path: str) -> tuple[np.ndarray, np.ndarray]:
    """``ids`` of all chunks, one after another, and how many each has."""
    special = np.asarray(pc.match_substring(chunks, "<|"))
    plain = np.zeros(len(chunks), bool)
    if _plain(path) is not None:
        plain = np.asarray(pc.match_substring_regex(chunks, PLAIN)) & ~special
    pools, lengths, order = [], np.zeros(len(chunks), np.int64), []
    for some in (~plain & ~special, special):
        found = encode_chunks(chunks.filter(pa.array(some)).to_pylist(), path)
        pools.append(np.frombuffer(b"".join(found), np.uint32))
        order.append(np.flatnonzero(some))
        lengths[order[-1]] = [len(f) // 4 for f in found]
    if plain.any():
        pool, own = encode_plain(chunks.filter(pa.array(plain)), path)
        pools.append(pool)
        order.append(np.flatnonzero(plain))
        lengths[order[-1]] = own
    place = np.concatenate(order)
    begins = np.empty(len(chunks), np.int64)
    begins[place] = np.cumsum(lengths[place]) - lengths[place]
    return np.concatenate(pools)[ragged(begins, lengths)], lengths


class Remembered:
    """Chunks that a worker has met, with their ids in one pool: arrays, no object for each chunk."""

    def __init__(self, path: str, kind: pa.DataType):
        self.path, self.names, self.pool = path, pa.array([], kind), np.zeros(0, np.uint32)
        self.lengths, self.times = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def ids(self, chunks: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``pool, starts, lengths``: where the ids of each of these distinct chunks lie."""
        if len(self.names) > REMEMBERED or len(self.pool) > REMEMBERED * IDS_EACH:
            self._forget()
        at = pc.index_in(chunks, self.names)
        new = np.asarray(at.is_null())
        place = np.asarray(at.fill_null(0), dtype=np.int64)
        place[new] = len(self.names) + np.arange(new.sum())
        unknown = chunks.filter(pa.array(new))
        pool, lengths = encode_distinct(unknown, self.path)
        self.names = pa.concat_arrays([self.names, unknown])
        self.pool = np.concatenate([self.pool, pool])
        self.lengths = np.concatenate([self.lengths, lengths])
        self.times = np.concatenate([self.times, np.zeros(len(unknown), np.int64)])
        self.times[place] += 1
        starts = np.cumsum(self.lengths) - self.lengths
        return self.pool, starts[place], self.lengths[place]

    def _forget(self) -> None:
        """Keep chunks that were met again, if they are no more than half of what may be kept."""
        keep = self.times > 1
        if keep.sum() > REMEMBERED // 2 or self.lengths[keep].sum() > REMEMBERED * IDS_EACH // 2:
            keep[:] = False
        starts = np.cumsum(self.lengths) - self.lengths
        self.pool = self.pool[ragged(starts[keep], self.lengths[keep])]
        self.names, self.lengths = self.names.filter(pa.array(keep)), self.lengths[keep]
        self.times = np.ones(len(self.names), np.int64)


_SEEN: dict[tuple[str, pa.DataType], Remembered] = {}


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def text_slices(texts: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, pa.Array]]:
    """Consecutive slices of about ``most`` bytes, whole texts each, with their first row."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    sizes = np.asarray(pc.fill_null(pc.binary_length(texts), 0), dtype=np.int64)
    cells = (np.cumsum(sizes) - sizes) // most
    cuts = np.flatnonzero(np.diff(cells, prepend=-1)) if len(cells) else []
    for begin, end in zip(cuts, [*cuts[1:], len(sizes)]):
        yield int(begin), texts.slice(begin, end - begin)


def split_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """``codes, offsets, dictionary``: words of all texts as places in their distinct words.

    ``offsets`` has one entry more than texts. Null and blank texts have no words.
    """
    flat = pc.ascii_trim_whitespace(pc.fill_null(texts, ""))
    lists = pc.ascii_split_whitespace(flat)
    offsets = np.asarray(lists.offsets, dtype=np.int64)
    offsets = offsets - offsets[0]
    words = lists.flatten().dictionary_encode()
    codes = np.asarray(words.indices, dtype=np.int64)
    blank = np.asarray(pc.equal(pc.binary_length(flat), 0))
    if blank.any():
        present = np.ones(len(codes), bool)
        present[offsets[:-1][blank]] = False
        before = np.concatenate([[0], np.cumsum(present)])
        codes, offsets = codes[present], before[offsets]
    return codes, offsets, words.dictionary


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Places ``start, start + 1, ...`` of each run, one run after another."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - lengths), lengths)


def encode(texts: pa.Array, path: str) -> tuple[np.ndarray, np.ndarray]:
    """``ids`` (uint32) of all texts and the ``offsets`` of each text in them."""
    if _ignores_case(path):
        # Special tokens are found before case is dropped: texts that may hold one stay as they are.
        special = pc.fill_null(pc.match_substring(texts, "<|"), False)
        texts = pc.if_else(special, texts, pc.ascii_lower(texts))
    codes, offsets, dictionary = split_words(texts)
    kept = (path, dictionary.type)
    if kept not in _SEEN:
        _SEEN[kept] = Remembered(*kept)
    pool, starts, lengths = _SEEN[kept].ids(dictionary)
    each = lengths[codes]
    ids = pool[ragged(starts[codes], each)]
    ends = np.concatenate([[0], np.cumsum(each)])
    return ids, ends[offsets]
