"""Byte-level BPE encoding and decoding.

The merge ranks are compiled into a transducer that is determinised lazily.
Its nondeterministic form walks the vocabulary's trie and may, at the end of
every vocabulary entry, write that token and return to the trie's root, as
long as the new token can follow the previous one: merging the bytes of the
two by rank must give back exactly these two. A token sequence is the merge
result exactly when each of its neighbouring pairs passes that test, so one
path survives. A deterministic state is the set of live paths, each with the
tokens it has written beyond those that all live paths agree on; agreed tokens
are emitted at once, which bounds the lookahead by the longest vocabulary
entry. States and arcs are made when texts have missed them often, as most arcs of
a text are never needed again, and dropped together when there are too many. Until
then, and where there are too many inside one piece, the rest of the piece is walked
through the nondeterministic form, depth first, from the tokens emitted so far. Every
piece goes through the transducer, whatever its length; a vocabulary entry is no exception.

Decoding joins the bytes of the tokens and hands them on as text, a chunk of
tokens at a time, through an incremental UTF-8 state machine that keeps an
unfinished character until its remaining bytes come.

Null and empty texts have no tokens and decode to the empty text. Rows are
independent: repeated rows and ties need no rule, any further columns pass
through, an empty table gives an empty table.
"""

from __future__ import annotations

import base64
import functools
import re
import struct
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Bounds of the caches of one Python worker. Both caches are emptied when
# full; results do not depend on them.
MAX_STATES = 80_000
MAX_PIECES = 300_000
# Output rows are handed to Spark in batches of about so many bytes.
BATCH_BYTES = 4 << 20
# Pieces of up to so many bytes go past the transducer: none do.
SHORT_PIECE = 0
# Tokens decoded at a time.
DECODE_CHUNK = 1 << 16


def parse_ranks(lines: Iterable[bytes]) -> dict[bytes, int]:
    """Token bytes to rank, from lines of ``base64 rank``."""
    pairs = (line.split() for line in lines if line.strip())
    return {base64.b64decode(token): int(rank) for token, rank in pairs}


def merge_by_rank(piece: bytes, ranks: dict[bytes, int], parts_left: int = 1) -> list[bytes]:
    """The definition of BPE: join the neighbouring pair of lowest rank until
    none has a rank, or ``parts_left`` parts remain."""
    parts = [piece[i : i + 1] for i in range(len(piece))]
    while len(parts) > parts_left:
        best = min(range(len(parts) - 1), key=lambda i: ranks.get(parts[i] + parts[i + 1], len(ranks)))
        if parts[best] + parts[best + 1] not in ranks:
            break
        parts[best : best + 2] = [parts[best] + parts[best + 1]]
    return parts


class LazyTransducer:
    """Bytes of one piece in, token ids out."""

    ROOT = 0
    NONE = -1
    # Keys of a node besides bytes.
    LONGEST, NUMBER = -1, -2
    # So often an arc is walked around before it is made.
    MET = 32

    def __init__(self, ranks: dict[bytes, int], max_states: int = MAX_STATES):
        self.ranks = ranks
        self.max_states = max_states
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self._length = {rank: len(token) for token, rank in ranks.items()}
        self._deepest = max(self._length.values(), default=0)
        # The trie: byte -> child, LONGEST -> the longest entry that ends at the node or above, NUMBER -> its place in nodes.
        self.nodes: list[dict[int, dict | int | None]] = [{self.LONGEST: None, self.NUMBER: self.ROOT}]
        self.token_at: dict[int, int] = {}
        # The longest entry that a longer one begins with.
        self._shorter: dict[int, int | None] = {}
        for token, rank in sorted(ranks.items()):  # an entry comes after those that it begins with
            node = self.nodes[self.ROOT]
            for byte in token:
                if byte not in node:
                    node[byte] = {self.LONGEST: node[self.LONGEST], self.NUMBER: len(self.nodes)}
                    self.nodes.append(node[byte])
                node = node[byte]
            self._shorter[rank], node[self.LONGEST] = node[self.LONGEST], rank
            self.token_at[node[self.NUMBER]] = rank
        self._follows: dict[tuple[int, int], bool] = {}
        # How often an arc (state * 256 + byte) was missing.
        self._missed: dict[int, int] = {}
        self._edges: dict[tuple[bytes, int], list[tuple[bytes, int]]] = {}
        self._reset()

    def _reset(self) -> None:
        # A path: (last token written, trie node, tokens not yet agreed on).
        start = ((self.NONE, self.ROOT, ()),)
        self._number = {start: 0}
        self._paths = [start]
        # By state: byte -> next state and the tokens emitted on the way.
        self._arcs: list[dict[int, tuple[int, tuple[int, ...]]]] = [{}]
        self._final: list[tuple[int, ...]] = [()]
        self._missed.clear()

    def _edge(self, token: bytes, side: int) -> list[tuple[bytes, int]]:
        """The parts that hold the token's first (side 0) or last (side 1) byte
        while it is merged, smallest first, each with the rank of the merge that
        ends it (for the token itself: past all ranks)."""
        known = self._edges.get((token, side))
        if known is None:
            halves = merge_by_rank(token, self.ranks, 2) if len(token) > 1 else [token]
            if len(halves) == 1:
                known = []
            else:
                known = [(part, min(end, self.ranks[token])) for part, end in self._edge(halves[side], side)]
            known = self._edges[token, side] = [*known, (token, len(self.ranks))]
        return known

    def follows(self, last: int, token: int) -> bool:
        """Whether ``token`` may come right after ``last``: merging the bytes
        of both, no merge reaches over the border between them.

        The parts at the border change as their own merges take place, in
        order of rank. Two parts that meet merge if their joint rank comes
        before the merges that end them; of equal ranks the left one is first.
        """
        if last == self.NONE:
            return True
        left, right = self._edge(self.bytes_of[last], 1), self._edge(self.bytes_of[token], 0)
        i = j = 0
        while True:
            (x, x_ends), (y, y_ends) = left[i], right[j]
            joint = self.ranks.get(x + y)
            if joint is not None and joint < x_ends and joint <= y_ends:
                return False
            if i + 1 == len(left) and j + 1 == len(right):
                return True
            if x_ends <= y_ends and i + 1 < len(left):
                i += 1
            else:
                j += 1

    def _may_follow(self, last: int, token: int) -> bool:
        known = self._follows
        may = known.get((last, token))
        if may is None:
            if len(known) > 4 * self.max_states:
                known.clear()
            may = known[last, token] = self.follows(last, token)
        return may

    def walk(self, piece: bytes, agreed: list[int] | None = None) -> list[int]:
        """The tokens of a piece that begins with the agreed ones, by the nondeterministic form, without making states.

        Depth first, the longest entry before its prefixes. A place can be reached by one sequence of
        tokens only, so a place that led nowhere is never tried again, and the walk takes back no more
        steps than the piece has bytes.
        """
        known, shorter, length, deepest = self._follows.get, self._shorter, self._length, self._deepest
        out, nowhere, root, longest = agreed or [], set(), self.nodes[self.ROOT], self.LONGEST
        at, last = sum([length[t] for t in out]), out[-1] if out else self.NONE
        while at < len(piece):
            node = root
            for byte in piece[at : at + deepest]:
                child = node.get(byte)
                if child is None:
                    break
                node = child
            token = node[longest]  # every byte is an entry
            while True:
                while token is not None:
                    end = at + length[token]
                    if end not in nowhere:
                        may = known((last, token))
                        if may if may is not None else self._may_follow(last, token):
                            break
                    token = shorter[token]
                if token is not None:
                    break
                nowhere.add(at)
                token = out.pop()
                at -= length[token]
                token = shorter[token]
                last = out[-1] if out else self.NONE
            out.append(token)
            at, last = end, token
        return out

    def _make_arc(self, state: int, byte: int) -> tuple[int, tuple[int, ...]]:
        nodes, token_at, follows, root = self.nodes, self.token_at.get, self._follows.get, self.ROOT
        paths = []
        for last, node, written in self._paths[state]:
            child = nodes[node].get(byte)
            if child is None:
                continue
            node = child[self.NUMBER]
            paths.append((last, node, written))
            token = token_at(node)
            if token is not None:
                may = follows((last, token))
                if may is None:
                    may = self._may_follow(last, token)
                if may:
                    ended = (*written, token)
                    paths.append((token, root, ended))
        # What all paths have written is emitted. Paths stay in the order in
        # which their pending tokens began, so equal sets are equal tuples.
        first, agreed = paths[0][2], 0
        for token in first:
            if any(len(p[2]) <= agreed or p[2][agreed] != token for p in paths):
                break
            agreed += 1
        after = tuple(paths) if not agreed else tuple((last, node, written[agreed:]) for last, node, written in paths)
        number = self._number.get(after)
        if number is None:
            number = self._number[after] = len(self._paths)
            self._paths.append(after)
            self._arcs.append({})
            self._final.append(next((written for _, node, written in after if node == root), ()))
        arc = self._arcs[state][byte] = number, first[:agreed]
        return arc

    def encode(self, piece: bytes) -> list[int]:
        if len(self._paths) >= self.max_states:
            self._reset()
        state, out, arcs = 0, [], self._arcs
        for byte in piece:
            arc = arcs[state].get(byte)
            if arc is None:
                missed, key = self._missed, state << 8 | byte
                met = missed.get(key, 0)
                if met < self.MET or len(self._paths) >= self.max_states:
                    if len(missed) < 4 * self.max_states:
                        missed[key] = met + 1
                    return self.walk(piece, out)
                arc = self._make_arc(state, byte)
            state, emitted = arc
            if emitted:
                out += emitted
        out += self._final[state]
        return out


class Utf8Machine:
    """Incremental UTF-8: bytes in, finished characters out.

    The state is the unfinished character's bytes so far, with the number of
    bytes still due and the range allowed for the next one (Unicode, table
    3-7). Bytes that cannot continue become one U+FFFD, as does an
    unfinished character at the end.
    """

    def __init__(self):
        self._held = b""
        self._due = 0
        self._low, self._high = 0x80, 0xBF

    @staticmethod
    def _lead(byte: int) -> tuple[int, int, int] | None:
        """Continuation bytes due after a first byte, and the range of the first of them."""
        if byte < 0x80:
            return 0, 0x80, 0xBF
        if 0xC2 <= byte <= 0xDF:
            return 1, 0x80, 0xBF
        if 0xE0 <= byte <= 0xEF:
            return 2, 0xA0 if byte == 0xE0 else 0x80, 0x9F if byte == 0xED else 0xBF
        if 0xF0 <= byte <= 0xF4:
            return 3, 0x90 if byte == 0xF0 else 0x80, 0x8F if byte == 0xF4 else 0xBF
        return None

    def _step(self, data: bytes) -> str:
        out = []
        for byte in data:
            if self._due:
                if self._low <= byte <= self._high:
                    self._held += bytes((byte,))
                    self._due -= 1
                    self._low, self._high = 0x80, 0xBF
                    if not self._due:
                        out.append(self._held.decode())
                        self._held = b""
                    continue
                out.append(self.finish())
            lead = self._lead(byte)
            if lead is None:
                out.append("\ufffd")
            elif lead[0] == 0:
                out.append(chr(byte))
            else:
                self._due, self._low, self._high = lead
                self._held = bytes((byte,))
        return "".join(out)

    def feed(self, data: bytes) -> str:
        """The characters that ``data`` finishes. Whole characters between the
        two ends are decoded at once; only where there are none (or malformed
        bytes) does the machine go byte by byte."""
        start = self._due
        end = len(data)
        for back in range(1, min(4, len(data) - start) + 1):
            lead = self._lead(data[-back])
            if lead is not None:
                end -= back if lead[0] >= back else 0
                break
        if start < end:
            out = self._step(data[:start])
            if not self._due:
                try:
                    return out + data[start:end].decode() + self._step(data[end:])
                except UnicodeDecodeError:
                    pass
            return out + self._step(data[start:])
        return self._step(data)

    def finish(self) -> str:
        lost, self._held, self._due = bool(self._held), b"", 0
        self._low, self._high = 0x80, 0xBF
        return "\ufffd" if lost else ""


def _latin_pattern(pattern: str) -> re.Pattern:
    """The pattern over Latin-1 bytes, with the classes it names spelled out:
    the same matches, found faster, in texts that Latin-1 can hold."""
    in_class = {name: regex.compile(name) for name in (r"\p{L}", r"\p{N}", r"\s")}
    spelled = {name: "".join(re.escape(chr(i)) for i in range(256) if test.match(chr(i))) for name, test in in_class.items()}
    inside = re.sub(r"\[[^\]]*\]", lambda m: functools.reduce(lambda s, kv: s.replace(*kv), spelled.items(), m[0]), pattern)
    for name, members in spelled.items():
        inside = inside.replace(name, f"[{members}]")
    return re.compile(inside.replace(r"\S", f"[^{spelled[r'\s']}]").encode("latin-1"))


class _Pieces(dict):
    """Piece of text (or of its Latin-1 bytes) -> its ids as packed little-endian unsigned 32-bit integers."""

    def __init__(self, transducer: LazyTransducer):
        self.transducer = transducer

    def __missing__(self, piece: str | bytes) -> bytes:
        data = (piece if isinstance(piece, str) else piece.decode("latin-1")).encode()
        ids = self.transducer.encode(data)
        packed = self[piece] = struct.pack(f"<{len(ids)}I", *ids)
        return packed


class Codec:
    """Texts to packed token ids and back."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, max_states: int = MAX_STATES, max_pieces: int = MAX_PIECES):
        self._find = regex.compile(pattern).findall
        self._pieces = _Pieces(LazyTransducer(ranks, max_states))
        self._max_pieces = max_pieces
        self._bytes = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            self._bytes[rank] = token
        self._latin = _latin_pattern(pattern)

    def encode(self, text: str) -> bytes:
        if len(self._pieces) > self._max_pieces:
            self._pieces.clear()
        try:
            pieces = self._latin.findall(text.encode("latin-1"))
        except UnicodeEncodeError:
            pieces = self._find(text)
        return b"".join(map(self._pieces.__getitem__, pieces))

    def decode_stream(self, chunks: Iterable[list[int]]) -> Iterator[str]:
        """Text of a stream of id lists, each part as soon as its characters are whole."""
        machine = Utf8Machine()
        for ids in chunks:
            yield machine.feed(b"".join(map(self._bytes.__getitem__, ids)))
        yield machine.finish()

    def decode(self, packed: bytes) -> str:
        ids = np.frombuffer(packed, dtype="<u4")
        return "".join(self.decode_stream(ids[i : i + DECODE_CHUNK].tolist() for i in range(0, len(ids), DECODE_CHUNK)))


@functools.lru_cache(maxsize=2)
def _codec(vocabulary: bytes, pattern: str) -> Codec:
    """One codec for each Python worker, kept over its tasks."""
    return Codec(parse_ranks(vocabulary.splitlines()), pattern)


def _mapped(df: DataFrame, source: str, new: dict[str, T.DataType], vocabulary: bytes, pattern: str, work) -> DataFrame:
    """``df`` with new columns from ``work(codec, value of source) -> values``, null as empty."""
    spark = df.sparkSession
    shared = spark.sparkContext.broadcast(vocabulary)  # a vocabulary file: its size is fixed
    kept = [f for f in df.schema.fields if f.name not in new]
    schema = T.StructType([*kept, *(T.StructField(name, kind, False) for name, kind in new.items())])
    kinds = [pa.binary() if isinstance(kind, T.BinaryType) else pa.string() for kind in new.values()]
    names, keep = list(new), [f.name for f in kept]

    def run(batches):
        codec = _codec(shared.value, pattern)
        for batch in batches:
            values, old = batch.column(batch.schema.get_field_index(source)), batch.select(keep)
            start, rows, held = 0, [], 0
            for k, value in enumerate(values):
                rows.append(work(codec, value.as_py()))
                held += sum(map(len, rows[-1]))
                if held >= BATCH_BYTES or k + 1 == len(values):
                    made = [pa.array(column, kind) for column, kind in zip(zip(*rows), kinds)]
                    yield pa.RecordBatch.from_arrays([*old.slice(start, len(rows)).columns, *made], names=[*keep, *names])
                    start, rows, held = k + 1, [], 0

    return df.mapInArrow(run, schema)


def read_vocabulary(path: str) -> bytes:
    """A rank file of the driver's machine."""
    with open(path, "rb") as file:
        return file.read()


def encode_texts(
    df: DataFrame,
    vocabulary: str,
    pattern: str,
    text_col: str = "text",
    ids_col: str = "token_ids",
    decoded_col: str | None = None,
) -> DataFrame:
    """``df`` with ``ids_col``: the text's token ids as packed little-endian unsigned 32-bit integers.

    ``vocabulary`` is the path of a rank file; each match of ``pattern`` is
    encoded by itself; no special tokens. With ``decoded_col``, the ids are
    also decoded again in the same pass. Null texts count as empty. Columns of
    these names are replaced, all others pass through.
    """
    new = {ids_col: T.BinaryType()} | ({decoded_col: T.StringType()} if decoded_col else {})

    def work(codec: Codec, text: str | None):
        packed = codec.encode(text or "")
        return (packed, codec.decode(packed)) if decoded_col else (packed,)

    return _mapped(df, text_col, new, read_vocabulary(vocabulary), pattern, work)


def decode_ids(df: DataFrame, vocabulary: str, ids_col: str = "token_ids", text_col: str = "decoded") -> DataFrame:
    """``df`` with ``text_col``: the text of packed token ids (null: empty)."""
    new = {text_col: T.StringType()}
    return _mapped(df, ids_col, new, read_vocabulary(vocabulary), "", lambda codec, packed: (codec.decode(packed or b""),))
