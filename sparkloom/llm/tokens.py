"""Token ids of whole texts, by the ``tokenizers`` library, remembered word by word where that is exact."""

from __future__ import annotations

import functools
import json
import os
import re

import numpy as np

from sparkloom.llm.common import Remembered

_PLAIN = re.compile(r"([!-&(-/:-@\[-`{-~]*)([a-zß-öø-ÿ]*)([!-&(-/:-@\[-`{-~]*)")


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class Encoder(dict):
    """``ids(text)``: little-endian ids of a text, as bytes of ``dtype``.

    Where the tokenizer drops white space and never joins across it, the ids of a text are those of its words
    in a row. Words are then remembered, within a bound. A word of plain letters between punctuation is split
    as the tokenizer's own pattern splits it and goes to its model; any other word, and any text that may
    hold a special token, goes through the library whole.
    """

    limit = 700_000

    def __init__(self, path: str):
        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.dtype = np.dtype("<u2") if self.tokenizer.get_vocab_size() <= 1 << 16 else np.dtype("<u4")
        with open(path, encoding="utf-8") as f:
            self.by_word = _drops_space(json.load(f))
        letters = [chr(c) for c in range(0xDF, 0x100) if c != 0xF7]
        level = ByteLevel(add_prefix_space=False, use_regex=False)
        self.bytes_of = {ord(c): level.pre_tokenize_str(c)[0][0] for c in letters}
        self.cores: dict[str, bytes] = {}
        Remembered.tables.append(self)  # emptied where a later step of the same worker remembers words of its own

    def clear(self) -> None:
        super().clear()
        self.cores.clear()

    def whole(self, text: str) -> bytes:
        found = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)
        return np.array(found[0].ids, self.dtype).tobytes()

    def core(self, part: str, letters: bool) -> bytes:
        out = self.cores.get(part)
        if out is None:
            if letters:
                found = self.model.tokenize(part.translate(self.bytes_of))
                out = np.array([t.id for t in found], self.dtype).tobytes()
            else:
                out = self.whole(part)
            if len(part) <= 32 and len(self.cores) < self.limit:
                self.cores[part] = out
        return out

    def __missing__(self, word: bytes) -> bytes:
        text = word.decode()
        plain = _PLAIN.fullmatch(text if text.isascii() else text.lower() if _latin(text) else text)
        if plain:
            before, middle, after = plain.groups()
            out = (self.core(before, False) if before else b"") + (self.core(middle, True) if middle else b"") \
                + (self.core(after, False) if after else b"")
        else:
            out = self.whole(text)
        if len(word) <= 32 and len(self) < self.limit:
            self[word] = out
        return out

    def ids(self, text: bytes | None) -> bytes:
        if not text:
            return b""
        if not self.by_word or b"<|" in text:
            return self.whole(text.decode())
        if text.isascii():
            return b"".join(map(self.__getitem__, text.lower().split()))
        # the library composes before it lower-cases, so other words stay as they stand
        return b"".join(self[w.lower() if w.isascii() else w] for w in text.split())


def _latin(text: str) -> bool:
    return max(text) <= "ÿ"


def _drops_space(config: dict) -> bool:
    """Whether the pieces of a text are those of its words: letters, one digit or a run of anything but space."""
    steps = [x.get("type") for x in (config.get("normalizer") or {}).get("normalizers", [])]
    splits = [x for x in (config.get("pre_tokenizer") or {}).get("pretokenizers", []) if x.get("type") == "Split"]
    marks = all(t["content"].startswith("<|") for t in config.get("added_tokens", []))
    return (steps == ["NFC", "Replace", "Lowercase"] and marks and len(splits) == 1 and splits[0]["invert"]
            and splits[0]["behavior"] == "Removed"
            and splits[0]["pattern"].get("Regex", "").endswith(r"[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
            and (config["model"].get("end_of_word_suffix") == "</w>"))


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder per worker process and tokenizer file."""
    return Encoder(path)
