"""BPE encoding by prefix-sharing trie traversal, and decoding.

For a BPE vocabulary every prefix of a word has one *last token*: the token that
ends the encoding of that prefix.  The encoding of a prefix is the encoding of
the shorter prefix before its last token, plus that token.  The last token at a
position is the one vocabulary entry ``t`` ending there for which ``t`` stays
unmerged beside the last token of the prefix before it.

The distinct words of a batch are inserted into a trie, which is walked depth
first: each trie node (a prefix) gets its last token once, however many words share
it.  A word ends with its last letter in end-of-word form, a leaf below the node of
its other letters; its ids are read back from there.  The walk goes over the sorted
words with a stack of the current path, so the trie is never held whole and a word
takes memory in proportion to its length.

Defined cases: null or empty text has no ids and decodes to the empty text; null
and repeated ids are kept row by row; an empty table gives no rows; other columns
are not read.
"""

from __future__ import annotations

import gc
import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from streetflow.llm.bpe import WordEncoder, library, specials
from streetflow.llm.common import held, id_and_text, slices

CODED = "doc_id long, n_tokens long, ids binary, decoded string"
#: Bytes of text whose distinct words are walked at once; bytes of pieces and number of pairs kept per worker.
WALK_BYTES, HELD_BYTES, PAIRS = 8 << 20, 160 << 20, 500_000
#: What an entry of a dictionary takes beside its strings.
ENTRY_BYTES = 300
SHORT = [2, 1]


class TrieCoder:
    """Encodes sets of words of one vocabulary file; words are in byte letters."""

    def __init__(self, path: str):
        model = json.loads(library(path).to_str())["model"]
        if model["type"] != "BPE" or not model["end_of_word_suffix"] or model.get("dropout"):
            raise ValueError(f"{path}: a BPE vocabulary with an end-of-word suffix is needed")
        self.suffix = model["end_of_word_suffix"]
        self.vocab: dict[str, int] = model["vocab"]
        self.names = {i: t for t, i in self.vocab.items()} | {i: t for t, i in specials(path).items()}
        self.packed = {i: i.to_bytes(4, "little") for i in self.names}
        merges = [tuple(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
        self.rank = {m: r for r, m in enumerate(merges)}
        made = {a + b for a, b in merges}
        reached = {t: i for t, i in self.vocab.items() if t in made or len(t.removesuffix(self.suffix)) == 1}
        #: Tokens that can end a prefix inside a word, and those that end a word.
        self.inner = {t: i for t, i in reached.items() if not t.endswith(self.suffix)}
        self.final = {t.removesuffix(self.suffix): i for t, i in reached.items() if t.endswith(self.suffix)}
        #: By the last three letters: the lengths of the tokens ending so, longest first.
        self.inner_lengths, self.final_lengths = self.by_tail(self.inner), self.by_tail(self.final)
        #: (left id << 16 | right id) -> whether the two stay unmerged side by side.
        self.stays: dict[int, bool] = {}

    @staticmethod
    def by_tail(tokens: dict[str, int]) -> dict[str, list[int]]:
        lengths: dict[str, set[int]] = {}
        for t in tokens:
            lengths.setdefault(t[-3:], set()).add(len(t))
        short = lambda tail: {n for n in (1, 2) if tail[-n:] in tokens}
        return {tail: sorted(ns | short(tail), reverse=True) for tail, ns in lengths.items()}

    def merged(self, letters: list[str]) -> list[str]:
        """Plain BPE: merge the leftmost pair of lowest rank until none is left."""
        while len(letters) > 1:
            best = min((self.rank.get(p, len(self.rank)), i) for i, p in enumerate(zip(letters, letters[1:], strict=False)))
            if best[0] == len(self.rank):
                break
            i = best[1]
            letters[i : i + 2] = [letters[i] + letters[i + 1]]
        return letters

    def letters(self, token: str, ends: bool) -> list[str]:
        out = list(token)
        if ends:
            out[-1] += self.suffix
        return out

    def unmerged(self, left: int, right: int) -> bool:
        """Whether the strings of two tokens, side by side, are encoded as just these two;
        ``left`` is -1 for a token that begins the word."""
        names = self.names
        want = [names[right]] if left < 0 else [names[left], names[right]]
        ends = names[right].endswith(self.suffix)
        spelt = ([] if left < 0 else list(names[left])) + self.letters(names[right].removesuffix(self.suffix) if ends else names[right], ends)
        if len(self.stays) >= PAIRS:
            self.stays.clear()
        known = self.stays[(left << 16) | right] = self.merged(spelt) == want
        return known

    def last(self, word: str, end: int, lasts: list[int], table: dict[str, int], lengths: dict[str, list[int]]) -> tuple[int, int]:
        """(id, length) of the last token of ``word[:end]``, given those of all shorter prefixes."""
        stays = self.stays
        for n in lengths.get(word[end - 3 : end] if end > 2 else word[:end], SHORT):
            if n <= end and (token := table.get(word[end - n : end])) is not None:
                left = lasts[end - n]
                known = stays.get((left << 16) | token)
                if known or (known is None and self.unmerged(left, token)):
                    return token, n
        raise ValueError(f"no token of the vocabulary ends {word[:end]!r}")

    def encode(self, words: set[str]) -> dict[str, bytes]:
        """Ids of each word as little-endian uint32.  ``lasts[d]`` and ``lengths[d]`` are the last token and its
        length of the node at depth d of the current path; a word keeps the path that it shares with the one
        before, and its ids are read by one walk back from its end."""
        out: dict[str, bytes] = {}
        lasts: list[int] = [-1]
        lengths: list[int] = [0]
        packed = self.packed
        before = ""
        inner, final, inner_lengths, final_lengths, last = self.inner, self.final, self.inner_lengths, self.final_lengths, self.last
        for word in sorted(words):
            size = len(word)
            most, shared = min(len(lasts), size) - 1, 0
            while shared < most and before[shared] == word[shared]:
                shared += 1
            del lasts[shared + 1 :], lengths[shared + 1 :]
            for end in range(shared + 1, size):
                token, n = last(word, end, lasts, inner, inner_lengths)
                lasts.append(token)
                lengths.append(n)
            token, n = last(word, size, lasts, final, final_lengths)
            ids, at = [packed[token]], size - n
            while at:
                ids.append(packed[lasts[at]])
                at -= lengths[at]
            ids.reverse()
            out[word] = b"".join(ids)
            before = word
        return out

    def decode(self, ids: bytes) -> str:
        """As the library does without a decoder: token strings joined by a space."""
        return " ".join(map(self.names.__getitem__, memoryview(ids).cast("I")))


class Coder:
    """Whole texts: words by the file's own split, ids by the trie walk."""

    def __init__(self, path: str):
        if json.loads(library(path).to_str())["decoder"] is not None:
            raise ValueError(f"{path}: decoding is defined for files without a decoder")
        self.words = WordEncoder(path, 1)
        self.trie = TrieCoder(path)
        self.special = specials(path)
        #: By whether the piece is a plain one or a word as the library spells it:
        #: piece -> (ids as uint32 bytes, token strings)
        self.known: dict[bool, dict[str, tuple[bytes, str]]] = {True: {}, False: {}}
        self.held = 0

    def units(self, text: str) -> tuple[list[str], bool]:
        """The text's pieces; False if they are words as the library's own stages spell them."""
        cut = self.words.cut(text)
        if cut is not None:
            return cut, True
        tok, out, rest = self.words.tok, [], text
        while rest:
            at, mark = min(((rest.find(m), m) for m in self.special if m in rest), default=(len(rest), ""))
            shown = tok.normalizer.normalize_str(rest[:at])
            out += [w for w, _ in tok.pre_tokenizer.pre_tokenize_str(shown)]
            if mark:
                out.append(mark)
            rest = rest[at + len(mark) :]
        return out, False

    def learn(self, pieces: set[str], plain: bool) -> None:
        """Encode the distinct pieces that are not known yet by one walk."""
        split = self.words._words.findall
        words = {p: [p] if not plain else [self.words.spell(w) for w in split(p.lower())] for p in pieces}
        marks = {} if plain else {m: self.trie.packed[i] for m, i in self.special.items()}
        walked = self.trie.encode({w for ws in words.values() for w in ws} - marks.keys()) | marks
        for p, ws in words.items():
            ids = b"".join(map(walked.__getitem__, ws)) if len(ws) != 1 else walked[ws[0]]
            found = self.known[plain][p] = (ids, self.trie.decode(ids))
            self.held += len(p) + len(ids) + len(found[1]) + ENTRY_BYTES

    def code(self, texts: list[str]) -> list[tuple[bytes, str]]:
        """(ids as little-endian uint32, decoded text) of each text.

        The walk makes many small objects and no cycles; the collector rests meanwhile.
        """
        gc.disable()
        try:
            return self._code(texts)
        finally:
            gc.enable()

    def _code(self, texts: list[str]) -> list[tuple[bytes, str]]:
        cuts = [self.units(t) for t in texts]
        for plain, known in self.known.items():
            self.learn({p for cut, how in cuts if how is plain for p in cut if p not in known}, plain)
        out = []
        for cut, plain in cuts:
            found = list(map(self.known[plain].__getitem__, cut))
            out.append((b"".join([f[0] for f in found]), " ".join([f[1] for f in found])))
        if self.held > HELD_BYTES:  # keep what these texts used, mostly frequent pieces
            used = {plain: {p for cut, how in cuts if how is plain for p in cut} for plain in self.known}
            self.known = {plain: {p: known[p] for p in used[plain]} for plain, known in self.known.items()}
            self.held = sum(len(p) + len(ids) + len(t) + ENTRY_BYTES for known in self.known.values() for p, (ids, t) in known.items())
        return out


def coder(path: str) -> Coder:
    return held("bpe_trie", path, lambda: Coder(path))


def encode_decode(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_tokens, ids, decoded)``: ids as little-endian uint32, and the decoded text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = coder(tokenizer)
        for batch in batches:
            for part in slices(batch, "text", WALK_BYTES):
                coded = c.code(part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([len(i) // 4 for i, _ in coded], pa.int64()), pa.array([i for i, _ in coded], pa.binary()), pa.array([t for _, t in coded], pa.string())],
                    names=["doc_id", "n_tokens", "ids", "decoded"],
                )

    return id_and_text(docs, id_col, text_col).mapInArrow(run, CODED)
