"""Exact token ids of whole texts with a public tokenizer, inside Arrow tasks.

The word-BPE tokenizer splits at white space before it merges, and neither its
normalizer nor its patterns reach over white space, so the ids of a text are
those of its words one after another; a file with other settings (``splits_at_blanks``) is asked for whole texts.  Arrow splits a batch of texts and finds
its distinct words; a worker keeps the ids of the words that it has met (up to
``CACHE_WORDS``, then it starts anew) and asks the tokenizer only for new ones,
and words of letters go straight to its merges, without the normalizer.
"""

from __future__ import annotations

import os
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CACHE_WORDS = 600_000
# fixed value: the pattern of the words of word_bpe_49k.json
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
# ASCII punctuation but the apostrophe: a run of it behind letters is a piece of its own
_MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
_LATIN = "\xff"  # the last Latin-1 letter
_ENCODERS: dict[str, "WordEncoder"] = {}


def vocabulary_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def load_tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    return t


def splits_at_blanks(tokenizer) -> bool:
    """Whether a tokenizer's settings are those that encoding word by word rests on: texts are composed, white space
    becomes blanks, letters lower case; then words are cut out without their blanks, and no special token needs its place."""
    import json

    made = json.loads(tokenizer.to_str())
    kinds = lambda part, name: [x["type"] for x in (part or {}).get(name, [])]
    cut = ((made["pre_tokenizer"] or {}).get("pretokenizers") or [{}])[0]
    return (kinds(made["normalizer"], "normalizers") == ["NFC", "Replace", "Lowercase"]
            and kinds(made["pre_tokenizer"], "pretokenizers") == ["Split", "ByteLevel"]
            and cut["pattern"].get("Regex") == WORD_PATTERN and cut["behavior"] == "Removed" and cut["invert"]
            and made["model"]["type"] == "BPE" and not made["model"].get("dropout") and not made["post_processor"]
            and not any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in made["added_tokens"]))


class WordEncoder:
    """Ids of texts as little-endian 16-bit bytes (32-bit for larger vocabularies), by a word cache."""

    def __init__(self, path: str):
        from tokenizers.pre_tokenizers import ByteLevel

        self.tokenizer = load_tokenizer(path)
        self.by_words = splits_at_blanks(self.tokenizer)
        self.model = self.tokenizer.model
        size = self.tokenizer.get_vocab_size()
        self.dtype = np.dtype("<u2" if size <= 1 << 16 else "<u4")
        self.code = "H" if self.dtype.itemsize == 2 else "I"
        self.known: dict[str, bytes] = {"": b""}
        # the characters that stand for a letter's bytes in the vocabulary
        show = ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        self.shown = {i: show(chr(i))[0][0] for i in range(0x80, 0x100)}

    def _ask(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, dtype=self.dtype).tobytes()
                for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]

    def _ask_stems(self, stems: list[str]) -> list[bytes]:
        """Lower-case words of Latin-1 letters alone: one piece each, which the normalizer leaves as it is."""
        merge, shown, code = self.model.tokenize, self.shown, self.code
        return [array(code, [t.id for t in merge(w if w.isascii() else w.translate(shown))]).tobytes() for w in stems]

    def _learn(self, words: set[str], sure: bool) -> None:
        """Ask for the ids of new words.

        The ids of a lower-case word of letters with marks behind are those of the word and of the marks.
        ``sure``: words are in lower case, and their letters Latin-1, so that it doesn't depend on their place.
        """
        known = self.known
        alone = [w for w in words if w.isalpha()]
        other = list(words.difference(alone))
        bare = [w.rstrip(_MARKS) for w in other]
        marked = [(w, b, w[len(b):]) for w, b in zip(other, bare, strict=True) if b.isalpha()]
        whole = [w for w, b in zip(other, bare, strict=True) if not b.isalpha()]
        if not sure:
            odd = {w for w in (*alone, *[b for _, b, _ in marked]) if w != w.lower() or max(w) > _LATIN}
            whole += [w for w in alone if w in odd] + [w for w, b, _ in marked if b in odd]
            alone = [w for w in alone if w not in odd]
            marked = [m for m in marked if m[1] not in odd]
        need = list({*alone, *[b for _, b, _ in marked]}.difference(known))
        known.update(zip(need, self._ask_stems(need), strict=True))
        whole += {m for _, _, m in marked}.difference(known)
        known.update(zip(whole, self._ask(whole), strict=True))
        known.update([(w, known[b] + known[m]) for w, b, m in marked])

    def few(self, text: str) -> bytes:
        """The ids of a word or two, kept like a word's."""
        if text not in self.known:
            self.known[text] = self._ask([text])[0]
        return self.known[text]

    @staticmethod
    def _plain(texts: pa.Array) -> tuple[pa.Array, bool]:
        """Texts in lower case where that is sure: all letters Latin-1, and no special token whose case counts."""
        offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1]
        raw = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
        odd = pc.match_substring(texts, "<|").to_numpy(zero_copy_only=False)
        if (raw >= 0xC4).any():
            seen = np.concatenate([[0], np.cumsum(raw >= 0xC4)])[offsets - offsets[0]]
            odd = odd | (seen[1:] > seen[:-1])
        if not odd.any():
            return pc.utf8_lower(texts), True
        return pc.if_else(pa.array(odd), texts, pc.utf8_lower(texts)), False

    def encode(self, texts: list[str] | pa.Array, at_once: int = 2048) -> list[bytes]:
        """The ids of each text; words of ``at_once`` texts are looked up together."""
        every = texts.cast(pa.string()) if isinstance(texts, pa.Array) else pa.array(texts, pa.string())
        if not self.by_words:  # another kind of tokenizer: whole texts
            return [x for i in range(0, len(every), 256) for x in self._ask(every.slice(i, 256).to_pylist())]
        out: list[bytes] = []
        for i in range(0, len(every), at_once):
            if len(self.known) > CACHE_WORDS:
                self.known = {"": b""}
            plain, sure = self._plain(every.slice(i, at_once))
            split = pc.ascii_split_whitespace(plain)
            ends = split.offsets.to_numpy()
            words = split.flatten().dictionary_encode()
            met, which = words.dictionary.to_pylist(), words.indices.to_numpy()
            new = {w for w in met if w not in self.known}
            if new:
                self._learn(new, sure)
            ids = list(map(self.known.__getitem__, met))
            sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // self.dtype.itemsize
            flat = np.frombuffer(b"".join(ids), self.dtype)
            own = sizes[which]
            stops = np.cumsum(own)
            # a word's ids in the texts, from its ids in the list of distinct words
            shift = (np.cumsum(sizes) - sizes)[which] - (stops - own)
            raw = flat[np.repeat(shift, own) + np.arange(stops[-1] if len(stops) else 0)].tobytes()
            at = (np.concatenate([[0], stops])[ends - ends[0]] * self.dtype.itemsize).tolist()
            out += [raw[a:b] for a, b in zip(at, at[1:])]
        return out


def word_encoder(path: str) -> WordEncoder:
    """The worker's encoder of a vocabulary file, kept between tasks."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def crc32_of_ids(ids: np.ndarray) -> int:
    """Unsigned crc32 of ids as little-endian unsigned 32-bit integers."""
    import zlib

    return zlib.crc32(ids.astype("<u4").tobytes())
