"""Pack documents into sequences of fixed length: first-fit decreasing in randomised groups of documents.

Documents are dealt at random into groups of about `group_bytes` of text; each group is tokenised and packed by
itself, in one task, from its own rows alone, so a lost executor costs some groups and the result stays. A row's
place in the input takes part in the draw, so copies of a row do not meet in one group. Ids stay with their rows in
Arrow and are never turned into floating-point numbers.
A document is cut into full sequences and a remainder. Remainders go, longest first, into the first
sequence with room, found in a tournament tree over the room of all open sequences. Then the emptiest
sequences are dissolved and poured into the gaps of the fullest, cutting pieces where a gap ends. What
remains in a group is less than one sequence; it is split into lengths that are powers of two, so that
nothing is padded.

Defined cases: a null text is empty and has only the end id; rows that repeat an id are packed each by
itself; an empty table has no pieces.
"""

from __future__ import annotations

import json
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from adlens.llm.memory import give_back

LENGTH = 4096
END_ID = 2
#: About so many bytes of texts in a group, and of remembered words in a worker; forgetting these only costs time.
GROUP_BYTES = 4 << 20
KNOWN_BYTES = 32 << 20
#: What a remembered word takes beside its bytes and ids: where both begin, and when it was last used.
WORD_COST = 24
#: Words that go to the tokenizer as one text.
TOGETHER = 2000
#: Sequences of one group get numbers of their own below this.
SEQUENCES = 1 << 24
PUNCTUATION = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum())


class WordEncoder:
    """Token ids of texts; each different chunk between ASCII white space is encoded once.

    Texts are split and words numbered in Arrow; remembered words and their ids lie in two arrays, so that only new
    words become Python objects.

    Right for tokenizers that drop white space and never look across it. If all ids that end a word are known by
    their `suffix`, plain words are encoded many at a time and the ids cut after each of these; marks behind a word
    are then encoded apart from it, as the tokenizer itself would split them.

    If the tokenizer reads capitals as small letters, A-Z are made small first, where no combining mark could join
    them, and words of a-z go to its vocabulary alone, without the steps that would leave them as they are.
    """

    def __init__(self, path: str, suffix: str = "</w>") -> None:
        self.tokenizer = Tokenizer.from_file(path)
        self.lowers = self._ids("AZ") == self._ids("az")
        self.plain = self.tokenizer
        if self.lowers and self._ids("az q az") == self._ids("az") + self._ids("q") + self._ids("az"):
            rules = json.loads(self.tokenizer.to_str()) | {"normalizer": None, "added_tokens": []}
            self.plain = Tokenizer.from_str(json.dumps(rules | {"pre_tokenizer": {"type": "WhitespaceSplit"}}))
        self.ends = np.zeros(self.tokenizer.get_vocab_size(), bool)
        for word, number in self.tokenizer.get_vocab().items():
            self.ends[number] = word.endswith(suffix)
        self.words = pa.array([], pa.large_string())
        self.found = pa.array([], pa.large_binary())
        self.used = np.zeros(0, np.int64)  # the call that last asked for a word
        self.calls = 0
        self.ending: dict[str, bool] = {}

    def _ids(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _small(self, texts: pa.LargeStringArray) -> pa.LargeStringArray:
        """A-Z as small letters, but in texts that may hold special tokens, which are spelled in small letters, or
        marks that compose with A-Z, which start with these two bytes."""
        if not self.lowers:
            return texts
        raw = texts.cast(pa.large_binary())
        kept = [pc.match_substring(raw, mark) for mark in (b"<|", b"\xcc", b"\xcd")]
        return pc.if_else(pc.or_(pc.or_(kept[0], kept[1]), kept[2]), texts, pc.ascii_lower(texts))

    def encode(self, texts: pa.LargeStringArray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts on end, each with the end id behind it, and where each text begins, and the last ends."""
        chunks = pc.ascii_split_whitespace(self._small(texts))
        words = chunks.values.dictionary_encode()
        units = self._units(words.dictionary).dictionary_encode()
        ids = self.look_up(units.dictionary).take(units.indices)
        ids = pa.concat_arrays([_spans(_offsets(ids)[::2], ids), pa.array([np.array([end_id], "<u4").tobytes()], ids.type)])
        behind = np.asarray(chunks.offsets)
        run = ids.take(pa.array(np.insert(words.indices, behind[1:], len(ids) - 1)))
        bounds = _offsets(run)[behind + np.arange(len(behind))] // 4
        return np.frombuffer(run.buffers()[2], "<u4", bounds[-1]), bounds

    def _units(self, chunks: pa.LargeStringArray) -> pa.LargeStringArray:
        """In turn the word of each chunk and the marks behind it, where the tokenizer splits there whatever they are;
        else the whole chunk and nothing."""
        words = pc.ascii_rtrim(chunks, PUNCTUATION)
        begin, lengths = _offsets(chunks), np.asarray(pc.binary_length(words))
        marked = pa.array(np.flatnonzero(lengths < np.diff(begin)), pa.int64())
        last = pc.utf8_slice_codeunits(words.take(marked), -1).dictionary_encode()
        ends = np.array([self._ends_word(c) for c in last.dictionary.to_pylist()], bool)[np.asarray(last.indices)]
        ends &= ~pc.match_substring(chunks.take(marked), "<|").to_numpy(zero_copy_only=False)
        split = np.asarray(marked)[ends]
        cuts = np.repeat(begin, 2)[1:]
        cuts[2 * split + 1] = begin[split] + lengths[split]
        return _spans(cuts, chunks)

    def _ends_word(self, char: str) -> bool:
        """If the tokenizer splits between a word with this last character and a mark behind it."""
        if char not in self.ending:
            ids = self._ids(char)
            self.ending[char] = bool(ids) and bool(self.ends[ids[-1]]) and self._ids(char + "!") == ids + self._ids("!")
        return self.ending[char]

    def look_up(self, units: pa.LargeStringArray) -> pa.LargeBinaryArray:
        """Ids of different words and marks; those not remembered are learned."""
        at = pc.index_in(units, value_set=self.words)
        new = units.filter(at.is_null())
        places = np.asarray(at.fill_null(-1)).astype(np.int64)
        places[places < 0] = len(self.words) + np.arange(len(new))
        found = pa.array(self.learn(_as_list(new)), self.found.type)
        self.words, self.found = pa.concat_arrays([self.words, new]), pa.concat_arrays([self.found, found])
        self.used = np.append(self.used, np.zeros(len(new), np.int64))
        self.calls += 1
        self.used[places] = self.calls
        ids = self.found.take(pa.array(places))
        self.forget()
        return ids

    def forget(self) -> None:
        """Drop the words that were not asked for longest, if all take more room than they may."""
        cost = np.diff(_offsets(self.words)) + np.diff(_offsets(self.found)) + WORD_COST
        if cost.sum() > KNOWN_BYTES:
            late = np.argsort(-self.used, kind="stable")
            kept = np.sort(late[np.cumsum(cost[late]) <= KNOWN_BYTES // 2])
            self.words, self.found, self.used = self.words.take(pa.array(kept)), self.found.take(pa.array(kept)), self.used[kept]

    def learn(self, units: list[bytes]) -> list[bytes]:
        small = [u for u in units if u.isalpha() and u.islower()]
        others = [u for u in units if not u.isascii() and u.decode().isalpha()]
        found = {}
        for words, tokenizer in ((small, self.plain), (others, self.tokenizer)):
            for k in range(0, len(words), TOGETHER):
                found |= self._together(words[k : k + TOGETHER], tokenizer)
        rest = [u for u in units if u not in found]
        for unit, ids in zip(rest, self.tokenizer.encode_batch_fast([u.decode() for u in rest], add_special_tokens=False), strict=True):
            found[unit] = np.array(ids.ids, "<u4").tobytes()
        return [found[u] for u in units]

    def _together(self, words: list[bytes], tokenizer: Tokenizer) -> dict[bytes, bytes]:
        """Ids of words of letters; nothing if the ids do not fall into as many words as went in."""
        ids = np.array(tokenizer.encode_batch_fast([b" ".join(words).decode()], add_special_tokens=False)[0].ids, "<u4")
        ends = (4 * (np.flatnonzero(self.ends[ids]) + 1)).tolist()
        if len(ends) != len(words) or ends[-1] != 4 * len(ids):
            return {}
        raw = ids.tobytes()
        return {w: raw[a:b] for w, a, b in zip(words, [0, *ends[:-1]], ends, strict=True)}


def _offsets(values: pa.LargeBinaryArray) -> np.ndarray:
    """Where each value begins in the bytes, and the last ends."""
    return np.frombuffer(values.buffers()[1], np.int64, len(values) + 1, 8 * values.offset) if len(values) else np.zeros(1, np.int64)


def _spans(offsets: np.ndarray, values: pa.LargeBinaryArray) -> pa.LargeBinaryArray:
    """The bytes of `values` cut at other places."""
    places = pa.py_buffer(np.ascontiguousarray(offsets))
    return pa.Array.from_buffers(values.type, len(offsets) - 1, [None, places, values.buffers()[2] or pa.py_buffer(b"")])


def _as_list(chunks: pa.LargeStringArray) -> list[bytes]:
    """The chunks, none of which holds a line feed."""
    whole = pa.ListArray.from_arrays([0, len(chunks)], chunks.cast(pa.large_binary()))
    return pc.binary_join(whole, pa.scalar(b"\n", pa.large_binary()))[0].as_py().split(b"\n") if len(chunks) else []


@lru_cache(maxsize=1)
def encoder_for(path: str) -> WordEncoder:
    """One encoder for all tasks that a worker runs."""
    return WordEncoder(path)


def first_fit_decreasing(sizes: np.ndarray, room: int) -> np.ndarray:
    """The bin of each size: sizes from largest to smallest, each into the first bin with room."""
    leaves = 1 << max(int(len(sizes) - 1).bit_length(), 0)
    tree = [room] * (2 * leaves)  # each inner node holds the larger room of its two players
    bins = np.zeros(len(sizes), np.int64)
    for k in np.argsort(-sizes, kind="stable").tolist():
        size, node = int(sizes[k]), 1
        while node < leaves:
            node *= 2
            if tree[node] < size:
                node += 1
        bins[k] = node - leaves
        tree[node] -= size
        while node > 1:
            node //= 2
            tree[node] = max(tree[2 * node], tree[2 * node + 1])
    return bins


def pack_lengths(lengths: list[int], room: int = LENGTH) -> list[tuple[int, int, int, int, int]]:
    """Pieces (document, start, length, sequence, offset) that hold each token once."""
    full = [(d, s, room) for d, n in enumerate(lengths) for s in range(0, n - n % room, room)]
    rest = [(d, n - n % room, n % room) for d, n in enumerate(lengths) if n % room]
    bins: dict[int, list] = {}
    for piece, b in zip(rest, first_fit_decreasing(np.array([p[2] for p in rest]), room) if rest else [], strict=True):
        bins.setdefault(int(b), []).append(piece)
    filled = [[sum(p[2] for p in pieces), pieces] for pieces in bins.values()]
    filled.sort(key=lambda x: -x[0])
    lo, hi = 0, len(filled) - 1
    while lo < hi:  # pour the emptiest into the gaps of the fullest
        gap = room - filled[lo][0]
        if not gap:
            lo += 1
            continue
        d, s, n = filled[hi][1].pop()
        part = min(gap, n)
        filled[lo][1].append((d, s, part))
        filled[lo][0] += part
        filled[hi][0] -= part
        if part < n:
            filled[hi][1].append((d, s + part, n - part))
        if not filled[hi][0]:
            hi -= 1
    sequences = [[p] for p in full] + [pieces for total, pieces in filled if total == room]
    for total, pieces in filled:
        if 0 < total < room:
            sequences += _powers_of_two(total, pieces)
    out = []
    for q, pieces in enumerate(sequences):
        offset = 0
        for d, s, n in pieces:
            out.append((d, s, n, q, offset))
            offset += n
    return out


def _powers_of_two(total: int, pieces: list) -> list[list]:
    out, pieces = [], pieces[::-1]
    for bit in reversed(range(total.bit_length())):
        need, own = total & (1 << bit), []
        while need:
            d, s, n = pieces.pop()
            part = min(need, n)
            own.append((d, s, part))
            need -= part
            if part < n:
                pieces.append((d, s + part, n - part))
        if own:
            out.append(own)
    return out


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    length: int = LENGTH,
    group_bytes: int = GROUP_BYTES,
    end_id: int = END_ID,
    with_ids: bool = False,
) -> DataFrame:
    """Pieces: `doc_id`, `start`, `length`, `ids_crc32`, `doc_tokens`, `sequence_id`, `offset`; on request the `ids`."""
    rows = docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text")
    )
    size = rows.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    groups = max(1, -(-size // group_bytes))
    place = F.xxhash64("doc_id", F.octet_length("text"), F.substring("text", 1, 64), F.monotonically_increasing_id())
    dealt = rows.withColumn("pack", F.pmod(place, F.lit(groups)))

    def packed(key: tuple, table: pa.Table) -> pa.Table:
        table = pa.table({"doc_id": table["doc_id"], "text": table["text"].cast(pa.large_string())})
        table = table.sort_by([("doc_id", "ascending"), ("text", "ascending")])
        ids, bounds = encoder_for(tokenizer_path).encode(table["text"].combine_chunks(), end_id)
        sizes, starts = np.diff(bounds).tolist(), bounds.tolist()
        pieces = pack_lengths(sizes, length)
        cut = [ids[starts[d] + s : starts[d] + s + n] for d, s, n, _, _ in pieces]
        columns = {
            "doc_id": table["doc_id"].take(pa.array([p[0] for p in pieces], pa.int64())),
            "start": pa.array([p[1] for p in pieces], pa.int64()),
            "length": pa.array([p[2] for p in pieces], pa.int64()),
            "ids_crc32": pa.array([zlib.crc32(x) for x in cut], pa.int64()),
            "doc_tokens": pa.array([sizes[p[0]] for p in pieces], pa.int64()),
            "sequence_id": pa.array([key[0].as_py() * SEQUENCES + p[3] for p in pieces], pa.int64()),
            "offset": pa.array([p[4] for p in pieces], pa.int64()),
        }
        if with_ids:
            columns["ids"] = pa.array([x.astype(np.int64) for x in cut], pa.list_(pa.int64()))
        del table, ids, cut
        give_back()
        return pa.table(columns)

    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    return dealt.groupBy("pack").applyInArrow(packed, schema + (", ids array<long>" if with_ids else ""))
