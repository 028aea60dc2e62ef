"""Access to public vocabulary files. Their path is a parameter; executors get the file's bytes with the task."""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from dataclasses import dataclass
from functools import lru_cache


def public_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@dataclass(frozen=True)
class TokenizerFile:
    """A vocabulary file of at most a few MB: its bytes and the digest that names its version."""

    kind: str  # "sentencepiece" or "tokenizers"
    content: bytes

    @classmethod
    def read(cls, path: str) -> TokenizerFile:
        with open(path, "rb") as file:
            return cls("sentencepiece" if path.endswith(".model") else "tokenizers", file.read())

    @property
    def digest(self) -> str:
        return hashlib.sha256(self.kind.encode() + b"\0" + self.content).hexdigest()

    def counter(self) -> Callable[[list[str]], list[int]]:
        """Token counts of texts, without begin, end or added special tokens."""
        return _counter(self.kind, self.content)


@lru_cache(maxsize=4)
def _counter(kind: str, content: bytes) -> Callable[[list[str]], list[int]]:
    if kind == "sentencepiece":
        import sentencepiece

        processor = sentencepiece.SentencePieceProcessor(model_proto=content)
        return lambda texts: [len(ids) for ids in processor.encode(texts, num_threads=1)]
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(content.decode())
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return lambda texts: [len(e.ids) for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
