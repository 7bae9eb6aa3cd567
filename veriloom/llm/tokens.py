"""Token counts: batches balanced by bytes are encoded inside Arrow functions, which return lengths only."""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veriloom.llm.common import byte_slices

BATCH_BYTES = 2 << 20
WINDOW_CHARS = 1 << 18
#: Of the memo of a worker, both halves together, about; and of an entry besides its piece and ids.
MEMO_BYTES, ENTRY_BYTES = 32 << 20, 180
#: Places, a byte each, for hashes of pieces that were met.
MET = 1 << 22

# A byte-level BPE cuts a text into words before it merges. Two kinds of places are always such a cut: where white space
# follows something that isn't, and where a comma or full stop follows a letter. Pieces between them encode on their own.
_A = r" \t-\r"
_LETTER = "A-Za-zÀ-ÖØ-öø-ɏ"
_PIECE = re.compile(rf"[{_A}]*[^{_A},.]+(?:(?<![{_LETTER}])[,.][^{_A}]*)?|[{_A}]*[,.][^{_A}]*|[{_A}]+")
# white space beyond ASCII, and what libraries differ on: such texts are cut less finely
_ODD = r"\x1c-\x1f\x85\xa0\u1680\u180e\u2000-\u200b\u2028\u2029\u202f\u205f\u3000\ufeff"
_ODD_SPACE = re.compile(f"[{_ODD}]")
_SAFE = re.compile(rf"[^{_A}{_ODD}][{_A}]")
# of a text in which no two white spaces meet each is such a place
_RUNS = ("\t", "\v", "\f", "\r", "  ", " \n", "\n ", "\n\n")
_POINT = re.compile(rf"[,.](?<=[{_LETTER}].)")
_CUT = "\x01"  # texts that hold it are encoded whole
_WHITE = frozenset(" \t\n\v\f\r")


class Encoder:
    """A tokenizer file with a memo of the ids of pieces; one per Python worker and file, reused by its tasks."""

    _open: dict[str, Encoder] = {}

    @classmethod
    def of(cls, path: str) -> Encoder:
        if path not in cls._open:
            cls._open[path] = cls(path)
        return cls._open[path]

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark runs one task per core
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        pre = self.tokenizer.pre_tokenizer
        plain = [(i, t.content) for i, t in self.tokenizer.get_added_tokens_decoder().items()
                 if not (t.lstrip or t.rstrip or t.single_word or t.normalized) and not re.search(rf"[{_A},.]", t.content)]
        every = len(plain) == len(self.tokenizer.get_added_tokens_decoder())
        self.cuts = (isinstance(pre, pre_tokenizers.ByteLevel) and not pre.add_prefix_space and pre.use_regex
                     and self.tokenizer.normalizer is None and bool(plain) and every)
        self.mark_id, self.mark = plain[0] if plain else (None, None)
        self.specials = [c for _, c in plain]
        alphabet = set(pre_tokenizers.ByteLevel.alphabet()) if self.cuts else set()
        vocab = self.tokenizer.get_vocab(with_added_tokens=False) if self.cuts else {}
        self.widths = np.zeros(max(vocab.values(), default=0) + 1, dtype=np.int64)  # bytes of each id; of use if every byte has one
        self.widths[list(vocab.values())] = [len(t) for t in vocab]
        self.bytewise = self.cuts and alphabet <= vocab.keys() and all(alphabet.issuperset(t) for t in vocab)
        self.memo: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.held = 0  # bytes of the memo without its older half
        self.met, self.n_met = np.zeros(MET, dtype=bool), 0  # hashes of pieces encoded so far

    def windows(self, text: str) -> Iterator[str]:
        """Parts of a long text, cut at safe places; whole if there are none or the tokenizer allows none."""
        at = 0
        while self.cuts and len(text) - at > WINDOW_CHARS:
            found = _SAFE.search(text, at + WINDOW_CHARS - 1)
            if not found:
                break
            yield text[at:found.start() + 1]
            at = found.start() + 1
        yield text[at:] if at else text

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype="<u4").tobytes()

    def _learn(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """New pieces' ids, and where each begins and how many it has, in few calls. Pieces that begin with white space and end without
        it are cut apart wherever they meet, so they form one text, and the bytes of the ids tell where each ends; the others are held
        apart by a special token, which is cut out before anything else."""
        spaced = np.fromiter((p[:1] in _WHITE and p[-1:] not in _WHITE for p in pieces), bool, len(pieces)) & self.bytewise
        begins, sizes = np.zeros(len(pieces), np.int64), np.zeros(len(pieces), np.int64)
        ids = np.zeros(0, "<u4")
        if spaced.any():
            run = list(compress(pieces, spaced))
            text = "".join(run)
            found = np.frombuffer(self._whole(text), dtype="<u4")
            widths = map(len, run) if text.isascii() else (len(p.encode()) for p in run)
            ends, reached = np.cumsum(np.fromiter(widths, np.int64, len(run))), np.cumsum(self.widths[found])
            at = np.searchsorted(reached, ends)
            if reached[-1] == ends[-1] and (reached[at] == ends).all():
                ids, begins[spaced], sizes[spaced] = found, np.append(0, at[:-1] + 1), np.diff(at + 1, prepend=0)
            else:
                spaced[:] = False
        if not spaced.all():
            found = np.frombuffer(self._whole(self.mark.join(compress(pieces, ~spaced))), dtype="<u4")
            ends = np.append(np.flatnonzero(found == self.mark_id), len(found))
            first = np.append(0, ends[:-1] + 1)
            begins[~spaced], sizes[~spaced] = len(ids) + first, ends - first
            ids = np.concatenate([ids, found])
        return ids, begins, sizes

    def _ids_of(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The ids of all pieces, each given once, and where each begins and how many it has. Those met for the second time are kept:
        most occur once, and would drive out the others."""
        if self.held > MEMO_BYTES // 2:  # a half starts anew, and takes over what is still in use; it grows by the pieces of one batch at most
            self.memo, self.older, self.held = {}, self.memo, 0
        known = list(map(self.memo.get, pieces))
        kept, fresh = {}, []
        for i in [i for i, x in enumerate(known) if x is None]:
            known[i] = self.older.get(pieces[i])
            if known[i] is None:
                known[i] = b""
                fresh.append(i)
            else:
                kept[pieces[i]] = known[i]
        sizes = np.fromiter(map(len, known), np.int64, len(known)) // 4
        begins, flat = np.cumsum(sizes) - sizes, np.frombuffer(b"".join(known), dtype="<u4")
        if fresh:
            new = [pieces[i] for i in fresh]
            ids, first, n = self._learn(new)
            begins[fresh], sizes[fresh] = len(flat) + first, n
            flat = np.concatenate([flat, ids])
            places = np.fromiter(map(hash, new), np.int64, len(new)) & (len(self.met) - 1)
            again = self.met[places]
            self.met[places] = True
            self.n_met += len(new) - int(again.sum())
            if self.n_met > len(self.met) // 4:
                self.met[:], self.n_met = False, 0
            kept.update(zip(compress(new, again), _parts(ids, first[again], (first + n)[again])))
        self.memo.update(kept)
        self.held += sum(map(len, kept)) + sum(map(len, kept.values())) + ENTRY_BYTES * len(kept)
        return flat, begins, sizes

    def encode(self, texts: list[str]) -> list[list[bytes]]:
        """The ids of every text as little-endian unsigned 32-bit parts, to be joined or measured."""
        out: list[list[bytes]] = []
        todo: list[list[bytes]] = []
        marked: list[str] = []

        def settle() -> None:
            if not marked:
                return
            lists = pc.split_pattern(pa.array(marked, pa.string()), _CUT)
            coded = lists.values.dictionary_encode()
            whole = pa.ListArray.from_arrays(pa.array([0, len(coded.dictionary)], pa.int32()), coded.dictionary)
            flat, begins, sizes = self._ids_of(pc.binary_join(whole, _CUT)[0].as_py().split(_CUT))
            of = coded.indices.to_numpy()
            reached = np.append(0, np.cumsum(sizes[of]))
            places = np.repeat(begins[of] - reached[:-1], sizes[of]) + np.arange(reached[-1])
            ends = reached[lists.offsets.to_numpy()]
            for parts, part in zip(todo, _parts(flat[places], ends[:-1], ends[1:]), strict=True):
                parts.append(part)
            todo.clear()
            marked.clear()

        held = 0
        for text in texts:
            out.append(parts := [])
            for window in self.windows(text):
                if not self.cuts or _CUT in window or _ODD_SPACE.search(window) or any(s in window for s in self.specials):
                    settle()
                    parts.append(self._whole(window))
                    continue
                todo.append(parts)
                marked.append(_marked(window))
                held += len(window)
                if held > BATCH_BYTES:
                    settle()
                    held = 0
        settle()
        return out


def _marked(window: str) -> str:
    """The text with a mark at places where it is always cut: before each white space if no two meet, else between the finer pieces."""
    if any(x in window for x in _RUNS):
        return _CUT.join(_PIECE.findall(window))
    return _POINT.sub(_CUT + r"\g<0>", window).replace(" ", _CUT + " ").replace("\n", _CUT + "\n")


def _parts(ids: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> list[bytes]:
    raw = ids.tobytes()
    return [raw[a:b] for a, b in zip((4 * begins).tolist(), (4 * ends).tolist(), strict=True)]


def token_counts(df: DataFrame, tokenizer: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",),
                 limit: int = 1024) -> DataFrame:
    """Columns ``keep``, n_bytes, n_tokens and over_limit of every row; a null text counts as empty.

    Every row is answered, repeated rows too; other columns, whatever their names, are not read. Texts of any length
    are encoded whole, in windows cut where the tokenizer cuts too. Special strings in a text are treated as the
    tokenizer file says; none are added.
    """
    source = df.select(*keep, F.coalesce(F.col(text).cast("string"), F.lit("")).alias("_text"))
    names = [*keep, "n_bytes", "n_tokens"]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.drop("_text").schema.fields)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder.of(tokenizer)
        for batch in batches:
            for part in byte_slices(batch, "_text", BATCH_BYTES):
                texts = part.column("_text")
                lengths = [sum(map(len, parts)) // 4 for parts in encoder.encode(texts.to_pylist())]
                columns = [part.column(k) for k in keep]
                columns += [pc.binary_length(texts).cast(pa.int64()), pa.array(lengths, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names)

    return (source.mapInArrow(count, f"{schema}, n_bytes bigint, n_tokens bigint")
            .withColumn("over_limit", F.col("n_tokens") > limit))
