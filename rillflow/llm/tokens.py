"""Token ids of many texts at once.

Both public vocabularies split a text into pre-tokens and merge inside each on
its own, so a text's ids are its pieces' ids joined. Pieces are cut at single
spaces and newlines, where every cut is also a pre-token boundary; the distinct
pieces of a batch are looked up once and only new ones reach the tokenizer.

A byte-level vocabulary whose ids follow its merges is also a table of ranks:
the lowest id is the earliest merge. Its texts are encoded whole from the ranks,
about twice as fast, without remembered pieces. Long unbroken runs and texts
with added tokens keep to the pieces and to the tokenizer.
"""

from __future__ import annotations

import json
import os
import re
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from rillflow.llm.shared import ranges, sums_between, text_bytes, words_from

CACHE_PIECES = 300_000
#: Bytes without a change between blank and other; texts with a longer run are cut into pieces.
LONGEST_RUN = 2000
# Fixed value: the cut of byte-level vocabularies.
_CUT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_MARK = ""
_OTHER_BLANK = "[\\t\\v\\f\\r\\x1c-\\x1f\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}\\x{e000}]|[ \\n][ \\n]"
_LETTERS_THEN_MARKS = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@\[-`{-~]*)")
_AFTER_WORD = re.compile(r"(?<=\S)(?=\s)")
_ENCODERS: dict[str, PieceEncoder] = {}


def encoder(path: str, pieces: int = CACHE_PIECES) -> PieceEncoder:
    """This worker's encoder of a tokenizer file, which remembers about ``pieces`` pieces, twice."""
    if path not in _ENCODERS:
        _ENCODERS[path] = PieceEncoder(path)
    _ENCODERS[path].most = pieces
    return _ENCODERS[path]


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in byte-level vocabularies: itself if printable, else one from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(others)}


def _ranks(file: dict) -> dict[bytes, int] | None:
    """The ranks of a byte-level vocabulary, or None where its file says anything else than plain merges in the order of their ids."""
    model, cut = file["model"], file.get("pre_tokenizer") or {}
    if cut.get("type") != "ByteLevel" or cut.get("add_prefix_space") or not cut.get("use_regex", True) or file.get("normalizer") or model.get("ignore_merges"):
        return None
    letters = {letter: byte for byte, letter in _byte_letters().items()}
    vocab = model["vocab"]
    merged = ["".join(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
    ids = [vocab.get(token, -1) for token in merged]
    singles = {letter: vocab.get(letter, len(vocab)) for letter in letters}
    if not ids or max(singles.values()) >= ids[0] or any(a >= b for a, b in zip(ids, ids[1:])):
        return None
    return {bytes(letters[c] for c in token): vocab[token] for token in (*singles, *merged)}


class PieceEncoder:
    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        self.keeps_spaces = file["normalizer"] is None
        self.by_rank = None
        if ranks := _ranks(file):
            import tiktoken

            self.by_rank = tiktoken.Encoding(path, pat_str=_CUT, mergeable_ranks=ranks, special_tokens={})
        self.tokenizer = Tokenizer.from_file(path)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.model = self.tokenizer.model
        self.most = CACHE_PIECES
        self.pieces: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.letters = _byte_letters()
        self.space = self.letters[32]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts as uint32 and each text's number of ids; a null text is empty."""
        if texts.null_count:
            texts = texts.fill_null("")
        whole = self._with_added(texts)
        if whole.any():
            ids, counts = self.encode(texts.filter(pa.array(~whole)))
            loose = [np.frombuffer(x, np.uint32) for x in self._whole(texts.filter(pa.array(whole)).to_pylist())]
            return self._merge(~whole, ids, counts, loose)
        if not self.keeps_spaces:
            return self._split(texts, None)
        if self.by_rank is not None:
            short = ~self._with_long_runs(texts)
            found = [np.array(self.by_rank.encode_ordinary(text), np.uint32) for text in texts.filter(pa.array(short)).to_pylist()]
            ids, counts = np.concatenate([np.zeros(0, np.uint32), *found]), np.array([len(x) for x in found], np.int64)
            if short.all():
                return ids, counts
            rest, lengths = self._by_pieces(texts.filter(pa.array(~short)))
            return self._merge(short, ids, counts, np.split(rest, np.cumsum(lengths)[:-1]))
        return self._by_pieces(texts)

    @staticmethod
    def _with_long_runs(texts: pa.Array) -> np.ndarray:
        """Texts with more than ``LONGEST_RUN`` bytes in a row that are all blanks or all not."""
        raw, offsets = text_bytes(texts)
        found = np.zeros(len(texts), bool)
        blank = (raw == 32) | ((raw >= 9) & (raw <= 13))
        edge = np.ones(len(raw) + 1, bool)
        edge[1:-1] = blank[1:] != blank[:-1]
        edge[offsets] = True
        edges = np.flatnonzero(edge)
        long = edges[:-1][np.diff(edges) > LONGEST_RUN]
        found[np.searchsorted(offsets, long, "right") - 1] = True
        return found

    def _by_pieces(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        plain = pc.invert(pc.match_substring_regex(texts, _OTHER_BLANK)).to_numpy(zero_copy_only=False)
        if plain.all():
            return self._split(texts, _MARK)
        ids, counts = self._split(texts.filter(pa.array(plain)), _MARK)
        return self._merge(plain, ids, counts, [self._by_piece(text) for text in texts.filter(pa.array(~plain)).to_pylist()])

    def _with_added(self, texts: pa.Array) -> np.ndarray:
        """Texts that hold an added token, in any case if the tokenizer lower-cases: it takes them out before it cuts, so these go to it whole."""
        found = np.zeros(len(texts), bool)
        for token in self.added:
            found |= pc.match_substring(texts, token, ignore_case=not self.keeps_spaces).to_numpy(zero_copy_only=False)
        return found

    @staticmethod
    def _merge(plain: np.ndarray, ids: np.ndarray, counts: np.ndarray, loose: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """The plain texts' ids and those of the other texts, in the order of the rows."""
        all_counts = np.zeros(len(plain), np.int64)
        all_counts[plain] = counts
        all_counts[~plain] = [len(x) for x in loose]
        starts = np.cumsum(all_counts) - all_counts
        out = np.empty(int(all_counts.sum()), np.uint32)
        out[ranges(starts[plain], counts)] = ids
        for start, own in zip(starts[~plain], loose):
            out[start:start + len(own)] = own
        return out, all_counts

    def _by_piece(self, text: str) -> np.ndarray:
        """Cuts only before white space that follows something else: always a boundary."""
        cut = [0, *(m.start() for m in _AFTER_WORD.finditer(text)), len(text)]
        pieces = [text[a:b] for a, b in zip(cut, cut[1:]) if a < b]
        known = {p: self.pieces.get("\0" + p) for p in set(pieces)}
        for piece, ids in zip(new := [p for p, ids in known.items() if ids is None], self._whole(new)):
            known[piece] = self.pieces["\0" + piece] = ids
        self._trim()
        return np.frombuffer(b"".join(known[p] for p in pieces), np.uint32)

    def _split(self, texts: pa.Array, mark: str | None) -> tuple[np.ndarray, np.ndarray]:
        if mark:
            texts = pc.binary_join_element_wise(mark, pc.replace_substring(texts, "\n", " \n"), "")
            parts = pc.split_pattern(texts, " ")
            offsets = parts.offsets.to_numpy().astype(np.int64)
            values, offsets = parts.values.slice(offsets[0], offsets[-1] - offsets[0]), offsets - offsets[0]
        else:
            raw, bounds = text_bytes(texts)
            inside = (raw != 32) & (raw != 10)
            values, offsets = words_from(raw, inside, bounds)
            values = values.cast(pa.large_string() if pa.types.is_large_binary(values.type) else pa.string())
        if not len(values):
            return np.zeros(0, np.uint32), np.zeros(len(texts), np.int64)
        encoded = values.dictionary_encode()
        codes = encoded.indices.to_numpy(zero_copy_only=False)
        by_piece = self._look_up(encoded.dictionary.to_pylist())
        lengths = np.fromiter(map(len, by_piece), np.int64, len(by_piece)) >> 2
        flat = np.frombuffer(b"".join(by_piece), np.uint32)
        starts = np.cumsum(lengths) - lengths
        per_word = lengths[codes]
        return flat[ranges(starts[codes], per_word)], sums_between(per_word, offsets)

    def _look_up(self, pieces: list[str]) -> list[bytes]:
        get = self.pieces.get
        found = [get(p) for p in pieces]
        older = self.older.get
        missing = []
        for i, ids in enumerate(found):
            if ids is None:
                found[i] = ids = older(pieces[i])
                if ids is None:
                    missing.append(i)
                else:
                    self.pieces[pieces[i]] = ids
        odd = []
        for i in missing:
            found[i] = ids = self._simple(pieces[i])
            if ids is None:
                odd.append(i)
        for i, ids in zip(odd, self._whole([self._literal(pieces[i]) for i in odd])):
            found[i] = ids
        self.pieces.update((pieces[i], found[i]) for i in missing)
        self._trim()
        return found

    def _trim(self) -> None:
        """Pieces not seen lately go: two generations, the older dropped when the newer is full."""
        if len(self.pieces) > self.most:
            self.pieces, self.older = {}, self.pieces

    def _literal(self, piece: str) -> str:
        if not self.keeps_spaces:
            return piece
        if piece[:1] == _MARK:
            return piece[1:]
        return piece if piece[:1] == "\n" else " " + piece

    def _simple(self, piece: str) -> bytes | None:
        """Ids of letters followed by ASCII marks, which are two pre-tokens; None for anything else."""
        if piece.isalpha() and piece.isascii():
            return self._spelled((self.space + piece) if self.keeps_spaces else piece.lower())
        head, body, bare = b"", piece, ""
        if self.keeps_spaces:
            if piece[:1] == _MARK:
                body, bare = piece[1:], _MARK
            elif piece[:1] == "\n":
                head, body, bare = self._part(_MARK + "\n"), piece[1:], _MARK
        parts = _LETTERS_THEN_MARKS.fullmatch(body)
        if parts is None:
            return None
        letters, marks = parts.groups()
        ids = head + self._part(bare + letters)
        return ids + self._part((_MARK if self.keeps_spaces else "") + marks) if marks else ids

    def _part(self, piece: str) -> bytes:
        """Ids of one pre-token, through the cache."""
        ids = self.pieces.get(piece)
        if ids is None:
            if not self.keeps_spaces:
                word = piece.lower()
            else:
                word = piece[1:] if piece[:1] == _MARK else " " + piece
            ids = self.pieces[piece] = self._spelled("".join(map(self.letters.__getitem__, word.encode())))
        return ids

    def _spelled(self, word: str) -> bytes:
        return array("I", [t.id for t in self.model.tokenize(word)]).tobytes()

    def _whole(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False) if texts else []
        return [np.array(e.ids, np.uint32).tobytes() for e in found]


def with_end(ids: np.ndarray, counts: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """The ids with ``end`` after each text, and the counts with it."""
    return np.insert(ids, np.cumsum(counts), np.uint32(end)), counts + 1
