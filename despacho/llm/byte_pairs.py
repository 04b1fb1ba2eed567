"""Ids of whole texts by a byte-level BPE tokenizer, each distinct word encoded once a task."""

from __future__ import annotations

import json

import numpy as np

from despacho.llm.words import PAD, SpanCache, gathered, loadable, span_hashes

KEPT = 1_000_000  # words a task remembers
JOINED = 20_000  # bytes of words that the tokenizer gets at once
BLANK = (9, 10, 11, 12, 13, 32)


def _marks(*values: int) -> np.ndarray:
    marks = np.zeros(256, bool)
    marks[list(values)] = True
    return marks


IS_BLANK, IS_STOP = _marks(*BLANK), _marks(*b".,")
IS_WORD = _marks(*b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz")
# Blanks beyond ASCII end with a byte from 80 to BF, as other characters do: nothing is cut behind these; 1C to 1F are blanks to some.
MAY_END_BLANK = _marks(*BLANK, *range(28, 32), *range(0x80, 0xC0))


def byte_characters() -> dict[str, int]:
    """The character a byte-level vocabulary shows for each byte: itself if printable, else the next free one from U+0100."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = sorted(set(range(256)) - set(shown))
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class ByteEncoder:
    """Encodes as ``tokenizers`` does with ``add_special_tokens=False``, text by text.

    Pre-tokenization never takes a blank to a character before it that isn't blank,
    nor a full stop or comma to a letter or digit before it. Texts are cut at these
    places, and ids of a distinct word (with the blanks before it) are made once. What the ids
    spell is compared with the text, so that two words of one hash are noticed;
    such a text is encoded as a whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            described = json.load(file)
        self._check(described)
        size = self.tokenizer.get_vocab_size()
        self.added = {i: t.content for i, t in self.tokenizer.get_added_tokens_decoder().items()}
        byte_of = byte_characters()
        spelled = [b""] * size
        for token, i in described["model"]["vocab"].items():
            spelled[i] = self.added[i].encode() if i in self.added else bytes(map(byte_of.__getitem__, token))
        for i, content in self.added.items():
            spelled[i] = content.encode()
        self.spell_lengths = np.array(list(map(len, spelled)), np.int64)
        self.spell_starts = np.cumsum(self.spell_lengths) - self.spell_lengths
        self.spell_pool = np.frombuffer(b"".join(spelled), np.uint8)
        self.fast = self._by_ranks(described, spelled)
        self.cache = SpanCache(KEPT)

    @staticmethod
    def _check(described: dict) -> None:
        before = described.get("pre_tokenizer") or {}
        plain = before.get("type") == "ByteLevel" and not before.get("add_prefix_space") and before.get("use_regex", True)
        added = described.get("added_tokens", [])
        if described.get("normalizer") or not plain or any(t["lstrip"] or t["rstrip"] or " " in t["content"] for t in added):
            raise ValueError("not a plain byte-level tokenizer")

    def _by_ranks(self, described: dict, spelled: list[bytes]):
        """The same vocabulary in ``tiktoken``, where its merges are in the order of their ids; else None."""
        model = described["model"]
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        ids = [model["vocab"]["".join(m)] for m in merges]
        if any(a >= b for a, b in zip(ids, ids[1:])):
            return None
        try:
            import public_tokenizers
            import tiktoken
        except ImportError:
            return None
        plain = {s: i for i, s in enumerate(spelled) if s and i not in self.added}
        special = {content: i for i, content in self.added.items()}
        return tiktoken.Encoding("byte-pairs", pat_str=public_tokenizers.PATTERN, mergeable_ranks=plain, special_tokens=special)

    def whole(self, texts: list[str]) -> list[list[int]]:
        """Ids of texts, none of them cut."""
        if self.fast is None:
            return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        if any(content in t for t in texts for content in self.added.values()):
            return [self.fast.encode(t, allowed_special="all") for t in texts]
        return [self.fast.encode_ordinary(t) for t in texts]

    def _words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words one behind the other, and how many each has.

        Words that begin with a blank, and those before them that don't end with
        one, are encoded many at once: what the ids spell tells them apart.
        """
        joined = [i for i, w in enumerate(words) if w[0] in BLANK and w[-1] < 0x80 and w[-1] not in BLANK]
        taken = set(joined)
        alone = [i for i in range(len(words)) if i not in taken]
        groups, size = [[]], 0
        for i in joined:
            if size > JOINED:
                groups.append([])
                size = 0
            groups[-1].append(words[i])
            size += len(words[i])
        flat = [i for ids in self.whole([b"".join(g).decode() for g in groups]) for i in ids]
        flat = np.array(flat, np.int64)
        ends = np.cumsum([len(words[i]) for i in joined])
        places = np.searchsorted(np.cumsum(self.spell_lengths[flat]), ends) + 1 if len(joined) else np.zeros(0, np.int64)
        counts = np.diff(places, prepend=0)
        rest = self.whole([words[i].decode() for i in alone])
        pool = np.concatenate([flat, np.array([i for ids in rest for i in ids], np.int64)])
        sizes = np.concatenate([counts, np.array([len(ids) for ids in rest], np.int64)])
        order = np.array(joined + alone, np.int64)
        starts, lengths = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        starts[order], lengths[order] = np.cumsum(sizes) - sizes, sizes
        return gathered(pool, starts, lengths), lengths

    def encode(self, texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and from where to where each text's go."""
        texts = [t or b"" for t in texts]
        sizes = np.array(list(map(len, texts)), np.int64)
        bounds = np.cumsum(np.concatenate([[0], sizes]))
        if not bounds[-1]:
            return np.zeros(0, np.int32), np.zeros(len(texts) + 1, np.int64)
        data = b"".join(texts)
        buffer = np.frombuffer(data + b"\0" * PAD, np.uint8)
        inside = buffer[: len(data)]
        cut = np.zeros(len(data), bool)
        cut[1:] = IS_BLANK[inside[1:]] & ~MAY_END_BLANK[inside[:-1]] | IS_STOP[inside[1:]] & IS_WORD[inside[:-1]]
        cut[bounds[:-1][sizes > 0]] = True
        starts = np.flatnonzero(cut)
        lengths = np.diff(starts, append=len(data))
        keys, first, inverse = np.unique(span_hashes(loadable(buffer), starts, lengths), return_index=True, return_inverse=True)

        def produce(missing):
            at = first[missing]
            return self._words([data[s : s + n] for s, n in zip(starts[at].tolist(), lengths[at].tolist())])

        pool, at, counts = self.cache.resolve(keys, produce)
        counts = counts[inverse]
        flat = gathered(pool, at[inverse], counts)
        ends = np.concatenate([[0], np.cumsum(counts)])[np.searchsorted(starts, bounds)]
        spelled = gathered(self.spell_pool, self.spell_starts[flat], self.spell_lengths[flat])
        if len(spelled) == len(data) and np.array_equal(spelled, inside):
            return flat, ends
        parts = [np.array(ids, np.int32) for ids in self.whole([t.decode() for t in texts])]
        return np.concatenate(parts), np.cumsum([0] + [len(p) for p in parts])
