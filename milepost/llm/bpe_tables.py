"""Tables of a byte-level BPE tokenizer file and the split of texts into
pre-tokens.  The file's place is a parameter; it is read once on the driver and
broadcast (its size is the vocabulary's, not the data's)."""

from __future__ import annotations

import json
import re

import numpy as np
import regex
from pyspark import Broadcast
from pyspark.sql import SparkSession

# Fixed value: the split pattern of byte-level BPE files with use_regex.
SPLIT = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
NO_RANK = np.int32(2**31 - 1)


def default_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in vocabulary strings:
    printable Latin-1 stands for itself, the rest follow from U+0100 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


class BpeTables:
    """Pair keys (sorted) with rank and product, byte symbols, token bytes, and
    the strings that are matched as whole tokens inside a text."""

    def __init__(self, raw: str):
        spec = json.loads(raw)
        model, pre = spec["model"], spec["pre_tokenizer"]
        if model["type"] != "BPE" or pre["type"] != "ByteLevel" or pre["add_prefix_space"] \
                or spec["normalizer"] or model.get("ignore_merges") or model.get("byte_fallback"):
            raise ValueError("only plain byte-level BPE files are supported")
        vocab = model["vocab"]
        letters = byte_alphabet()
        self.byte_symbol = np.array([vocab[c] for c in letters], np.int32)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        keys = np.array([vocab[a] << 32 | vocab[b] for a, b in pairs], np.int64)
        order = np.argsort(keys, kind="stable")
        first = np.unique(keys[order], return_index=True)[1]
        order = order[first]
        self.pair_key = keys[order]
        self.pair_rank = order.astype(np.int32)
        product = np.array([vocab[a + b] for a, b in pairs], np.int32)
        self.rank_product = product
        self.special = {}
        for t in spec["added_tokens"]:
            if t["lstrip"] or t["rstrip"] or t["single_word"]:
                raise ValueError("added tokens with strip or word flags are not supported")
            self.special[t["content"]] = t["id"]
        back = {c: b for b, c in enumerate(letters)}
        spelled = {i: bytes(back[c] for c in s) for s, i in vocab.items() if s not in self.special}
        spelled |= {i: s.encode() for s, i in self.special.items()}
        size = max(spelled) + 1
        parts = [spelled.get(i, b"") for i in range(size)]
        self.token_len = np.array([len(p) for p in parts], np.int64)
        self.token_at = np.cumsum(self.token_len) - self.token_len
        self.token_bytes = np.frombuffer(b"".join(parts), np.uint8)

    def splitter(self):
        if not self.special:
            return None
        longest = sorted(self.special, key=len, reverse=True)
        return re.compile("|".join(map(re.escape, longest)))

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each adjacent pair by binary search; NO_RANK where none merges."""
        key = left.astype(np.int64) << 32 | right
        at = np.minimum(np.searchsorted(self.pair_key, key), len(self.pair_key) - 1)
        return np.where(self.pair_key[at] == key, self.pair_rank[at], NO_RANK)


def pre_tokens(text: str, special: re.Pattern | None) -> list[str]:
    """Pre-tokens in order; a special string is one element of its own."""
    if special is None or special.search(text) is None:
        return SPLIT.findall(text)
    out, at = [], 0
    for m in special.finditer(text):
        out += SPLIT.findall(text, at, m.start()) if m.start() > at else []
        out.append(m[0])
        at = m.end()
    return out + SPLIT.findall(text, at)


def load(spark: SparkSession, path: str | None = None) -> Broadcast:
    with open(path or default_path(), encoding="utf-8") as f:
        return spark.sparkContext.broadcast(f.read())
