"""Whole-text tokenization with a bounded memo of white-space chunks.

The vocabulary's pre-tokenizer never joins characters across white space, so
the ids of a text are the concatenated ids of its space- and newline-separated
chunks.  Chunks repeat far more often than texts, so each worker memoizes them
and sends only unseen chunks through the tokenizer, many in one call.
"""

from __future__ import annotations

import json
import os
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

from samefold.llm.common import tokenizer_path

#: Chunks and words that one worker memoizes; when full, a memo keeps what the
#: texts at hand use.
MEMO = 320_000
#: Bytes of text tokenized at once.
SLICE = 4_000_000
#: Separator between unseen chunks in one call; a special token of its own.
MARK = "<|endoftext|>"
#: Chunks without characters from here on (all of them stable under NFC, U+0130 apart) are cut
#: into words here, by the vocabulary's own pre-tokenizer pattern (a fixed
#: value); others go through the tokenizer whole.
BEYOND = re.compile("[^\\x00-\\u02af]|\\u0130")
#: Symbols that end a chunk as one word of their own.
TRAILING = ".,;:!?*%$&#)"
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_LOADED: dict[str, "ChunkTokenizer"] = {}


class ChunkTokenizer:
    """``ids(texts)`` gives each text's ids as a little-endian uint32 array."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tok = Tokenizer.from_file(path)
        self.mark = self.tok.token_to_id(MARK)
        spec = json.loads(self.tok.to_str())
        steps = (spec.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
        norms = [n.get("type") for n in (spec.get("normalizer") or {}).get("normalizers", [])]
        tail = spec["model"].get("end_of_word_suffix")
        self.by_word = bool(tail) and norms == ["NFC", "Replace", "Lowercase"] and steps[0].get("pattern", {}).get("Regex") == WORDS
        if self.by_word:
            # words arrive lower-cased and cut, so only the byte mapping is left to do
            self.words = Tokenizer.from_file(path)
            self.words.normalizer = None
            self.words.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
            size = self.tok.get_vocab_size()
            self.ends = np.asarray([(self.tok.id_to_token(i) or "").endswith(tail) for i in range(size)])
            self.cut = regex.compile(WORDS).findall
        self.memo: dict[str, bytes] = {}
        self.word_memo: dict[str, bytes] = {}

    def _alone(self, chunk: str) -> bytes:
        return np.asarray(self.tok.encode(chunk, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _learn_words(self, new: list[str]) -> dict[str, bytes]:
        out = {}
        for i in range(0, len(new), 4000):
            part = new[i : i + 4000]
            ids = np.asarray(self.words.encode(" ".join(part), add_special_tokens=False).ids, dtype="<u4")
            ends = np.flatnonzero(self.ends[ids]) + 1
            if len(ends) != len(part):
                out.update((w, self._alone(w)) for w in part)
                continue
            raw = ids.tobytes()
            at = [0, *(ends * 4).tolist()]
            out.update((w, raw[a:b]) for w, a, b in zip(part, at, at[1:]))
        return out

    def _recall(self, words: list[str], memo: dict[str, bytes], learn) -> list[bytes]:
        """Ids of distinct words through a memo, which learns what it lacks."""
        got = list(map(memo.get, words))
        new = [w for w, g in zip(words, got) if g is None]
        if not new:
            return got
        learned = learn(new)
        if len(memo) + len(new) > MEMO:
            memo.clear()
            memo.update((w, g) for w, g in zip(words, got) if g is not None)
        memo.update(learned)
        return [learned[w] if g is None else g for w, g in zip(words, got)]

    def _learn(self, chunks: list[str]) -> dict[str, bytes]:
        out, plain, cut = {}, [], {}
        for c in chunks:
            if MARK[:2] in c or self.mark is None:
                out[c] = self._alone(c)
            elif self.by_word and not BEYOND.search(c):
                cut[c] = self.cut(c.lower())
            else:
                plain.append(c)
        if cut:
            used = list(set().union(*cut.values()))
            raw = dict(zip(used, self._recall(used, self.word_memo, self._learn_words)))
            for c, w in cut.items():
                out[c] = b"".join([raw[x] for x in w])
        for i in range(0, len(plain), 2000):
            part = plain[i : i + 2000]
            ids = np.asarray(self.tok.encode(MARK.join(part), add_special_tokens=False).ids, dtype="<u4")
            at = np.flatnonzero(ids == self.mark)
            if len(at) != len(part) - 1:
                out.update((c, self._alone(c)) for c in part)
                continue
            raw = ids.tobytes()
            starts = [0, *((at + 1) * 4).tolist()]
            ends = [*(at * 4).tolist(), len(raw)]
            out.update((c, raw[a:b]) for c, a, b in zip(part, starts, ends))
        return out

    def flat(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts in one array, and each text's bounds in it.

        Distinct chunks are looked at once: a word with its ending symbols is
        two pieces, any other chunk is one.
        """
        split = pc.split_pattern(pc.replace_substring(texts.fill_null(""), "\n", " "), " ")
        coded = split.flatten().dictionary_encode()
        chunks = coded.dictionary
        if self.by_word and len(chunks):
            part = pc.extract_regex(chunks, f"(?s)^(?P<core>.*?)(?P<tail>[{re.escape(TRAILING)}]*)$")
            core = pc.utf8_lower(part.field("core"))
            simple = pc.and_(pc.utf8_is_alpha(core), pc.invert(pc.match_substring_regex(chunks, r"[^\x{00}-\x{2af}]|\x{130}")))
            simple = simple.to_numpy(zero_copy_only=False)
        else:
            simple = np.zeros(len(chunks), bool)
        raw, first, second = [b""], np.zeros(len(chunks), np.int64), np.zeros(len(chunks), np.int64)

        def add(values, where, into, memo, learn):
            coded = values.filter(pa.array(where)).dictionary_encode()
            into[where] = coded.indices.to_numpy() + len(raw)
            raw.extend(self._recall(coded.dictionary.to_pylist(), memo, learn))

        if simple.any():
            add(core, simple, first, self.word_memo, self._learn_words)
            tailed = simple & (pc.binary_length(part.field("tail")).to_numpy() > 0)
            if tailed.any():
                add(part.field("tail"), tailed, second, self.memo, self._learn)
        if not simple.all():
            add(chunks, ~simple, first, self.memo, self._learn)
        sizes = np.fromiter(map(len, raw), np.int64, len(raw)) // 4
        pool = np.frombuffer(b"".join(raw), "<u4")
        starts = np.cumsum(sizes) - sizes
        at = coded.indices.to_numpy()
        pieces = np.stack([first[at], second[at]], axis=1).ravel()
        n = sizes[pieces]
        ends = np.cumsum(n)
        out = pool[np.repeat(starts[pieces] - (ends - n), n) + np.arange(ends[-1] if len(ends) else 0)]
        bounds = np.concatenate([[0], ends])[2 * (split.offsets.to_numpy() - split.offsets[0].as_py())]
        return out, bounds

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        out, bounds = self.flat(pa.array(texts, pa.string()))
        return [out[a:b] for a, b in zip(bounds, bounds[1:])]


def load(path: str | None = None) -> ChunkTokenizer:
    """The worker's tokenizer for ``path``, loaded once per process."""
    full = tokenizer_path(path)
    if full not in _LOADED:
        _LOADED[full] = ChunkTokenizer(full)
    return _LOADED[full]
