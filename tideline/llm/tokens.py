"""Token ids of whole texts exactly as the tokenizers library gives them.

For byte-level BPE files whose ids are the order of their merges, as that of the
public 50k vocabulary, the merges are read from the file into a faster encoder of
the same vocabulary.  Texts with characters on whose class the two libraries'
Unicode tables could differ, and all texts for any other file, go through the
tokenizers library itself.
"""

from __future__ import annotations

import json
import os
import re
from collections import Counter
from functools import lru_cache

import numpy as np
import regex
import tiktoken
from tokenizers import Tokenizer

#: Fixed value: the pre-token pattern of byte-level BPE.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Characters outside the blocks whose classes have long been settled.
_UNSETTLED = re.compile("[^\x00-ͷЀ-҂Ҋ-ԧḀ-ỿ‐-‧‰-⁞₠-₵\u3000-\u3003\u3041-\u3094\u30a1-\u30fa\u4e00-\u9fa5\uac00-\ud7a3\uff01-\uff0f\uff1a-\uff20]")
_PRE_TOKENS = regex.compile(PATTERN)
#: Characters from which on a piece is cut into the pre-tokens of the pattern.
LONG = 24
#: A space next to other white space; texts that hold one are cut by the slow rule.
_LOOSE = re.compile(r"\s | \s")
_CUT = re.compile(r"(?<=\S) (?=\S)")


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def pieces(text: str) -> list[str]:
    """``text`` cut before every single space between two visible characters.

    A byte-level pre-tokenizer never joins characters across such a space, and
    it begins the pre-token after it: pieces may be encoded on their own.
    """
    parts = text.split(" ") if not _LOOSE.search(text) else _CUT.split(text)
    return [parts[0], *(" " + p for p in parts[1:])]


def byte_characters() -> dict[str, int]:
    """The printable character that stands for each byte in byte-level files: the
    byte's own where it is visible, else one from 256 on in order."""
    visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in visible]
    return {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Encoder:
    """``cuttable``: whether the :func:`pieces` of a text may be encoded on their own,
    as may then the pre-tokens of the byte-level pattern within them."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallel workers
        self.library = Tokenizer.from_file(path)
        spec = json.loads(self.library.to_str())
        pre, model, added = spec.get("pre_tokenizer") or {}, spec["model"], spec["added_tokens"]
        bare = all(t["content"] and " " not in t["content"] and not (t["lstrip"] or t["rstrip"] or t["single_word"]) for t in added)
        self.cuttable = bare and spec.get("normalizer") is None and pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space") and pre.get("use_regex", True)
        self.added = [t["content"] for t in added]
        self.fast = None
        if self.cuttable and model["type"] == "BPE" and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")):
            byte, special = byte_characters(), {t["content"]: t["id"] for t in added}
            vocab = {k: v for k, v in model["vocab"].items() if k not in special and all(c in byte for c in k)}
            merged = [m[0] + m[1] if isinstance(m, list) else m.replace(" ", "", 1) for m in model["merges"]]
            if all(t["special"] for t in added) and len(vocab) == 256 + len(merged) and all(vocab.get(m) == 256 + i for i, m in enumerate(merged)):
                ranks = {bytes(byte[c] for c in k): v for k, v in vocab.items()}
                self.fast = tiktoken.Encoding(os.path.basename(path), pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)

    def ids(self, text: str) -> np.ndarray:
        """The ids of a text, without begin, end or added special tokens; special
        strings in it are what the library makes of them by default."""
        if self.fast is None or _UNSETTLED.search(text):
            return np.array(self.library.encode(text, add_special_tokens=False).ids, np.uint32)
        try:
            return self.fast.encode_to_numpy(text, allowed_special="all")
        except ValueError:  # white space so long that its pattern's stack is too small for it
            return np.array(self.library.encode(text, add_special_tokens=False).ids, np.uint32)

    def pre_tokens(self, text: str) -> Counter:
        """How often the text holds each of the parts that may be encoded on their own:
        its pieces, long ones cut by the byte-level pattern."""
        if not self.cuttable:
            return Counter([text] if text else [])
        count = Counter(pieces(text))
        count.pop("", None)
        for p in [p for p in count if len(p) > LONG]:
            if not _UNSETTLED.search(p) and not any(a in p for a in self.added):
                times = count.pop(p)
                for part in _PRE_TOKENS.findall(p):
                    count[part] += times
        return count


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder for each Python worker."""
    return Encoder(path)
