"""Encoding by byte-level vocabularies (``.json``).

The vocabulary file is read once and handed to the faster of two libraries that share its merge rule: ids number the merges
in their order, so a rank table says the same as the file. Where a file is built otherwise, or the faster library gives a text
up (white space by the million), the one that the file is written for encodes it.
"""

from __future__ import annotations

import json
import os
from collections.abc import Callable
from functools import lru_cache

Encode = Callable[[list[str]], list[list[int]]]

# Fixed value: how a byte-level vocabulary cuts a text before it merges.
PARTS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_letters() -> dict[str, int]:
    """The printable letters that byte-level vocabularies write for the 256 bytes: a printable Latin-1 byte is its own
    letter, the others take the letters from 256 on, in order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def _ranks(file: dict) -> dict[bytes, int] | None:
    """Bytes and ranks of the entries; None where the file asks for more than merges in the order of their ids."""
    model, cut, letters = file["model"], file.get("pre_tokenizer") or {}, byte_letters()
    vocab, merges = model.get("vocab", {}), model.get("merges", [])
    joined = ["".join(m) if isinstance(m, list) else m.replace(" ", "") for m in merges]
    fits = (
        model.get("type") == "BPE"
        and not file.get("normalizer")
        and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges"))
        and (cut.get("type"), cut.get("add_prefix_space"), cut.get("use_regex", True)) == ("ByteLevel", False, True)
        and len(vocab) == len(letters) + len(merges)
        and sorted(vocab.get(c, -1) for c in letters) == list(range(len(letters)))
        and all(vocab.get(entry) == len(letters) + i for i, entry in enumerate(joined))
    )
    return {bytes(letters[c] for c in entry): i for entry, i in vocab.items()} if fits else None


@lru_cache(maxsize=4)
def byte_level_encoder(path: str, specials: bool) -> Encode:
    """Ids of texts as the tokenizers library gives them without adding special tokens. With ``specials`` the strings of
    special tokens inside texts are those tokens, as is the library's default, else ordinary text."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
    import tiktoken
    from tokenizers import Tokenizer

    slow = Tokenizer.from_file(path)
    slow.encode_special_tokens = not specials

    def by_file(texts: list[str]) -> list[list[int]]:
        return [e.ids for e in slow.encode_batch_fast(texts, add_special_tokens=False)]

    with open(path, encoding="utf-8") as handle:
        file = json.load(handle)
    added = file.get("added_tokens") or []
    ranks = _ranks(file)
    if ranks is None or any(t.get("single_word") or t.get("lstrip") or t.get("rstrip") or not t.get("special") for t in added):
        return by_file
    special = {t["content"]: t["id"] for t in added}
    fast = tiktoken.Encoding(path, pat_str=PARTS, mergeable_ranks=ranks, special_tokens=special)

    def encode(text: str) -> list[int]:
        try:
            return fast.encode(text, allowed_special="all" if specials else set(), disallowed_special=())
        except ValueError:
            return by_file([text])[0]

    return lambda texts: [encode(text) for text in texts]
