"""Token ids of whole texts, as little-endian unsigned numbers in one binary value."""

from __future__ import annotations

import re
from array import array
from collections.abc import Callable

from pyspark.sql import SparkSession

#: Words whose ids a task remembers; all are forgotten at once when there are more.
REMEMBERED = 400_000
# Letters that stay themselves under composition and have one lower-case letter, then points and commas.
PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,]*)")
# Python splits at these, the tokenizer doesn't.
SEPARATORS = ("\x1c", "\x1d", "\x1e", "\x1f")


class WordEncoder:
    """Ids by a tokenizer that drops white space, so that each word between spaces has its own ids.

    Texts repeat their words far more often than their sentences. Each word goes through the
    library once and is remembered. A word of plain letters skips normalizing and splitting and
    goes to the model alone. Texts with special tokens or control separators go through the
    library whole. ``of`` gives exactly what the library gives for the text, with 4 bytes for each
    id, or with 2 if ``narrow`` is asked for and all ids of the vocabulary fit.
    """

    def __init__(self, path: str, narrow: bool = False):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.width = 2 if narrow and max(self.tokenizer.get_vocab().values(), default=0) < 1 << 16 else 4
        self.code = "H" if self.width == 2 else "I"
        self.model = self.tokenizer.model
        self.special = tuple(t.content for t in self.tokenizer.get_added_tokens_decoder().values())
        kept = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        others = [b for b in range(256) if b not in kept]
        self.letters = {b: 256 + i for i, b in enumerate(others)}
        self.words: dict[str, bytes] = {}
        self.parts: dict[str, bytes] = {}

    def whole(self, text: str) -> bytes:
        return array(self.code, self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def part(self, part: str) -> bytes:
        ids = self.parts.get(part)
        if ids is None:
            # ASCII letters and points stand for themselves
            known = self.model.tokenize(part if part.isascii() else part.encode().decode("latin-1").translate(self.letters))
            ids = self.parts[part] = array(self.code, [t.id for t in known]).tobytes()
        return ids

    def learn(self, word: str) -> None:
        plain = PLAIN.fullmatch(word)
        if plain is None:
            ids = self.whole(word)
        else:
            ids = self.part(plain[1].lower()) + (self.part(plain[2]) if plain[2] else b"")
        self.words[word] = ids

    def of(self, text: str) -> bytes:
        if any(s in text for s in self.special) or any(s in text for s in SEPARATORS):
            return self.whole(text)
        words = text.split()
        known = self.words
        if len(known) > REMEMBERED:
            known.clear()
            self.parts.clear()
        try:
            return b"".join([known[w] for w in words])
        except KeyError:
            for word in set(words).difference(known):
                self.learn(word)
            return b"".join([known[w] for w in words])


def kept_encoder(spark: SparkSession, path: str, narrow: bool = False) -> Callable[[], WordEncoder]:
    """What gives a task its encoder; a worker keeps it, and the words it knows, for its next tasks."""
    shared = spark.sparkContext.broadcast({"path": path})

    def encoder() -> WordEncoder:
        own = shared.value
        return own["encoder"] if "encoder" in own else own.setdefault("encoder", WordEncoder(own["path"], narrow))

    return encoder


def vocabulary(name: str = "word_bpe_49k.json") -> str:
    """The place of a public vocabulary; it is the same on every machine that has the package."""
    import public_tokenizers

    return public_tokenizers.path(name)
