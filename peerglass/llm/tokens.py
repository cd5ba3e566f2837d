"""Token ids in a binary format with Re-Pair grammars.

Documents are put in order of their id and cut into shards.  A shard's ids are compressed in blocks: frequent pairs of
neighbours are replaced by new symbols, round by round until none is left, and the rules are stored with the block, together with the length to which each
expands.  No pair crosses the end of a document, so a document is a run of symbols of its own: it is decoded alone, and
a position inside it is found from the expansion lengths.

A file row is one block: shard, place in the shard, documents (ids, first symbols, lengths), rules and symbols as little-endian
numbers of two bytes, or four where two are too few.  Spark writes the rows as Parquet into a shared folder.

Texts are encoded by the tokenizers library.  Texts are cut in front of single spaces, where its splitter always cuts, and equal pieces
are encoded once for each worker; the memory for that is bounded.

Defined cases: null text is empty and has the end id only; equal ids are put in order by text; a null id comes first; repeated rows are documents of
their own; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from peerglass.llm.scratch import Scratch

END = 0
BLOCK_IDS, RULES_A_ROUND, LEAST_COUNT = 1 << 18, 2000, 24
REMEMBERED, TOGETHER, BYTES_AT_ONCE = 400_000, 512, 8 << 20
#: How byte-level vocabularies write a space.
SPACE = "\u0120"
_HASH_BITS = 18

BLOCK = ("shard int, block bigint, first_id bigint, n_docs int, n_ids bigint, symbols int, doc_ids array<bigint>, doc_symbols binary, "
         "doc_lengths binary, rules binary, rule_lengths binary, body binary")


class Encoder:
    """The tokenizer, with a bounded memory of pieces: one for each worker and file."""

    _open: dict[str, "Encoder"] = {}

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        #: Strings that the tokenizer takes out of a text before it splits it.
        self.special = [token.content for token in self.tokenizer.get_added_tokens_decoder().values()]
        self.wide = self.tokenizer.get_vocab_size() > 0xFFFF
        self.kind = np.uint32 if self.wide else np.uint16
        self.known: dict[str, bytes] = {}
        self.spaced = np.zeros(self.tokenizer.get_vocab_size(), bool)
        for token, number in self.tokenizer.get_vocab().items():
            self.spaced[number] = token.startswith(SPACE)

    @classmethod
    def at(cls, path: str) -> "Encoder":
        if path not in cls._open:
            cls._open[path] = cls(path)
        return cls._open[path]

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        """Ids of each text and the end id; null is empty.

        A piece stands for itself behind a space.  One with white space at either end, or nothing in it, means that
        the text has longer white space; such a text is encoded as a whole, and so is one that holds a special string.
        """
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        if not len(texts):
            return []
        split = pc.split_pattern(texts, " ")
        bounds = split.offsets.to_numpy().astype(np.int64)
        begins, bounds = bounds[:-1] - bounds[0], bounds[1:] - bounds[0]
        flat = split.flatten()
        coded = flat.dictionary_encode()
        pieces, codes = coded.dictionary.to_pylist(), coded.indices.to_numpy().astype(np.int64)
        special = np.zeros(len(texts), bool)
        for string in self.special:
            special |= np.asarray(pc.match_substring(texts, string))
        ids = self._remember(pieces, self.special if special.any() else [])

        alone = bounds - begins == 1
        heads = [head if one or head and not head[-1].isspace() else None
                 for head, one in zip(flat.take(pa.array(begins)).to_pylist(), alone)]
        joined = np.array([not one for one in ids])[codes]
        joined[begins] = [head is None for head in heads]
        whole = np.logical_or.reduceat(joined, begins) | special

        # one table of all pieces, the texts' first pieces and the end id; texts are runs of its rows
        rows = ids + self._bytes([head or "" for head in heads]) + [np.array([END], self.kind).tobytes()]
        table = np.frombuffer(b"".join(rows), self.kind)
        sizes = np.fromiter(map(len, rows), np.int64, len(rows)) // table.itemsize
        codes[begins] = len(ids) + np.arange(len(heads))
        codes = np.insert(codes, bounds, len(rows) - 1)
        runs = sizes[codes]
        firsts = (np.cumsum(sizes) - sizes)[codes] - (np.cumsum(runs) - runs)
        line = table[np.repeat(firsts, runs) + np.arange(int(runs.sum()))]
        stops = np.cumsum(runs)[bounds + np.arange(len(heads))].tolist()
        out = [line[a:b] for a, b in zip([0, *stops[:-1]], stops)]
        for n in np.flatnonzero(whole).tolist():
            out[n] = np.frombuffer(self._bytes([texts[n].as_py()])[0] + rows[-1], self.kind)
        return out

    def _remember(self, pieces: list[str], special: list[str]) -> list[bytes]:
        """Ids of each piece behind a space, none for those that do not stand for themselves or hold a special string."""
        known = self.known
        found = list(map(known.get, pieces))
        fresh = [piece for piece, ids in zip(pieces, found) if ids is None]
        if len(known) + len(fresh) > REMEMBERED:
            # what this call uses stays, and with it the frequent pieces
            kept = {piece: ids for piece, ids in zip(pieces, found) if ids is not None}
            known.clear()
            known.update(kept)
        plain = [piece for piece in fresh if piece and piece.strip() == piece]
        if special:
            plain = [piece for piece in plain if not any(string in piece for string in special)]
        made = self._pieces(plain)
        if len(plain) < len(fresh):
            by_piece = dict(zip(plain, made))
            made = [by_piece.get(piece, b"") for piece in fresh]
        known.update(zip(fresh, made))
        rest = iter(made)
        return [next(rest) if ids is None else ids for ids in found]

    def _pieces(self, plain: list[str]) -> list[bytes]:
        """Ids of each piece behind a space.

        Many are encoded in one call.  They hold no space, so an id that starts with one starts a piece; where there are not as
        many of these as pieces, the pieces are encoded one by one.
        """
        out: list[bytes] = []
        for first in range(0, len(plain), TOGETHER):
            some = plain[first:first + TOGETHER]
            ids = np.array(self.tokenizer.encode_batch_fast([" " + " ".join(some)], add_special_tokens=False)[0].ids, self.kind)
            cuts = np.flatnonzero(self.spaced[ids])
            if len(cuts) == len(some) and cuts[0] == 0:
                data, width = ids.tobytes(), ids.itemsize
                stops = [*(cuts[1:] * width).tolist(), len(data)]
                out += [data[a:b] for a, b in zip((cuts * width).tolist(), stops)]
            else:
                out += self._bytes([" " + piece for piece in some])
        return out

    def _bytes(self, texts: list[str]) -> list[bytes]:
        made = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(one.ids, self.kind).tobytes() for one in made]


def _parts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Slices of about ``BYTES_AT_ONCE`` bytes of text, one row at least."""
    upto = np.cumsum(pc.fill_null(pc.binary_length(batch.column("_text")), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    first = 0
    while first < batch.num_rows:
        past = int(np.searchsorted(upto, (upto[first - 1] if first else 0) + BYTES_AT_ONCE, side="right"))
        past = max(past, first + 1)
        yield batch.slice(first, past - first)
        first = past


def _slot(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    mixed = left * np.uint32(0x9E3779B1) + right * np.uint32(0x85EBCA77)
    return (mixed ^ (mixed >> np.uint32(15))) * np.uint32(0x2C1B3C6D) >> np.uint32(32 - _HASH_BITS)


def _by_slot(left: np.ndarray, right: np.ndarray, slot: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place of an example of each frequent pair, pair of each place or -1); of pairs that share a slot only one is looked at."""
    table[slot] = np.arange(len(slot), dtype=np.int32)
    named = table[slot]
    fits = (left == left[named]) & (right == right[named])
    times = np.bincount(slot[fits], minlength=1 << _HASH_BITS)
    names = np.flatnonzero(times >= LEAST_COUNT)
    if len(names) > RULES_A_ROUND:
        names = np.sort(names[np.argsort(-times[names], kind="stable")[:RULES_A_ROUND]])
    number = np.full(1 << _HASH_BITS, -1, np.int64)
    number[names] = np.arange(len(names))
    return table[names], np.where(fits, number[slot], -1)


def _exactly(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same for all pairs, by sorting them."""
    pairs, example, pair, times = np.unique(left.astype(np.uint64) << np.uint64(32) | right, return_index=True, return_inverse=True,
                                            return_counts=True)
    often = np.flatnonzero(times >= LEAST_COUNT)
    number = np.full(len(pairs), -1, np.int64)
    number[often] = np.arange(len(often))
    return example[often], number[pair]


def repair(ids: np.ndarray, ends: np.ndarray, symbols: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(symbols, rules, ends): the compressed ids, the pair behind each new symbol, and where documents now end.

    Each round counts pairs of neighbours and replaces the non-overlapping places of frequent ones from left to right, until no
    pair occurs ``LEAST_COUNT`` times or more.  Rounds count pairs by hash, at most ``RULES_A_ROUND`` of them, most frequent
    first; when that finds none, what is left is counted exactly, so pairs that share a hash are not missed.
    """
    line = ids.astype(np.uint32)
    rules, table = np.zeros((0, 2), np.uint32), np.zeros(1 << _HASH_BITS, np.int32)
    while len(line) > 1:
        left, right = line[:-1], line[1:]
        slot = _slot(left, right).astype(np.intp)
        mask = (np.bincount(slot, minlength=1 << _HASH_BITS) >= LEAST_COUNT)[slot]
        mask[ends[:-1] - 1] = False  # no pair crosses the end of a document
        busy = np.flatnonzero(mask)
        examples, pair = _by_slot(left[busy], right[busy], slot[busy], table)
        if not len(examples):
            examples, pair = _exactly(left[busy], right[busy])
            if not len(examples):
                break
        made = np.stack([left[busy][examples], right[busy][examples]], 1)
        places, at = busy[pair >= 0], pair[pair >= 0]
        # in a run of places side by side every second one is taken
        fresh = np.ones(len(places), bool)
        fresh[1:] = places[1:] != places[:-1] + 1
        run_start = np.maximum.accumulate(np.where(fresh, np.arange(len(places)), 0))
        taken = (np.arange(len(places)) - run_start) % 2 == 0
        places, at = places[taken], at[taken]
        line[places] = symbols + len(rules) + at.astype(np.uint32)
        stays = np.ones(len(line), bool)
        stays[places + 1] = False
        ends = ends - np.searchsorted(places + 1, ends)
        line = line[stays]
        rules = np.concatenate([rules, made])
    return line, rules, ends


def expand(line: np.ndarray, rules: np.ndarray, symbols: int) -> np.ndarray:
    """Ids of a run of symbols: every rule's symbol becomes its pair, until none is left."""
    line = line.astype(np.int64)
    while (made := line >= symbols).any():
        sizes = made + 1
        at = (np.cumsum(sizes) - sizes)[made]
        pairs = rules[line[made] - symbols]
        line = np.repeat(line, sizes)
        line[at], line[at + 1] = pairs[:, 0], pairs[:, 1]
    return line


def rule_lengths(rules: np.ndarray, symbols: int) -> np.ndarray:
    """How many ids each rule stands for."""
    lengths = np.zeros(len(rules), np.int64)
    while not lengths.all():
        parts = np.where(rules >= symbols, lengths[np.where(rules >= symbols, rules - symbols, 0)], 1)
        lengths = np.where(parts.all(axis=1), parts.sum(axis=1), 0)
    return lengths


class Block:
    """One block, read from its row.  Documents, and ids inside them, are decoded without the others."""

    def __init__(self, row: dict) -> None:
        self.symbols, self.doc_ids = row["symbols"], row["doc_ids"]
        self.first = np.append(0, np.frombuffer(row["doc_symbols"], "<u4").astype(np.int64))
        self.lengths = np.frombuffer(row["doc_lengths"], "<u4").astype(np.int64)
        self.rules = np.frombuffer(row["rules"], "<u4").reshape(-1, 2).astype(np.int64)
        self.sizes = np.frombuffer(row["rule_lengths"], "<u4").astype(np.int64)
        wide = len(row["body"]) == 4 * int(self.first[-1])
        self.body = np.frombuffer(row["body"], "<u4" if wide else "<u2")

    def document(self, n: int) -> np.ndarray:
        return expand(self.body[self.first[n]:self.first[n + 1]], self.rules, self.symbols).astype("<u4")

    def token(self, n: int, place: int) -> int:
        """One id of a document: its symbol is found from the expansion lengths."""
        line = self.body[self.first[n]:self.first[n + 1]].astype(np.int64)
        sizes = np.ones(len(line), np.int64)
        made = line >= self.symbols
        sizes[made] = self.sizes[line[made] - self.symbols]
        upto = np.cumsum(sizes)
        at = int(np.searchsorted(upto, place, side="right"))
        return int(expand(line[at:at + 1], self.rules, self.symbols)[place - (upto[at] - sizes[at])])

    def all(self) -> list[np.ndarray]:
        # one table of what each symbol stands for; the block is a run of its rows
        made = np.arange(self.symbols, self.symbols + len(self.rules))
        table = np.concatenate([np.arange(self.symbols), expand(made, self.rules, self.symbols)]).astype("<u4")
        sizes = np.concatenate([np.ones(self.symbols, np.int64), self.sizes])
        runs = sizes[self.body]
        firsts = (np.cumsum(sizes) - sizes)[self.body] - (np.cumsum(runs) - runs)
        whole = table[np.repeat(firsts, runs) + np.arange(int(runs.sum()))]
        cuts = np.append(0, np.cumsum(self.lengths))
        if cuts[-1] != len(whole):
            raise ValueError("the block does not expand to the stored lengths")
        return [whole[a:b] for a, b in zip(cuts[:-1], cuts[1:])]


def _pack(block: int, doc_ids: list, docs: list[np.ndarray], symbols: int, first_id: int, shard: int) -> dict:
    ids = np.concatenate(docs)
    lengths = np.array([len(d) for d in docs], np.int64)
    line, rules, ends = repair(ids, np.cumsum(lengths), symbols)
    kind = "<u2" if symbols + len(rules) <= 1 << 16 else "<u4"
    return {"shard": shard, "block": block, "first_id": first_id, "n_docs": len(docs), "n_ids": len(ids), "symbols": symbols,
            "doc_ids": doc_ids, "doc_symbols": ends.astype("<u4").tobytes(), "doc_lengths": lengths.astype("<u4").tobytes(),
            "rules": rules.astype("<u4").tobytes(), "rule_lengths": rule_lengths(rules.astype(np.int64), symbols).astype("<u4").tobytes(),
            "body": line.astype(kind).tobytes()}


_BLOCK_SCHEMA = pa.schema([(n, {"int": pa.int32(), "bigint": pa.int64(), "binary": pa.binary(), "array<bigint>": pa.list_(pa.int64())}[k])
                           for n, k in (field.split() for field in BLOCK.split(", "))])


def encode_blocks(docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", column: str = "text") -> DataFrame:
    """Blocks of all documents in ascending order of their id; a shard is a range of ids, ``first_id`` counts within it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder, shard = Encoder.at(tokenizer), TaskContext.get().partitionId()
        symbols = encoder.tokenizer.get_vocab_size()
        block = first = size = 0
        doc_ids: list = []
        held: list[np.ndarray] = []
        for batch in batches:
            for part in _parts(batch):
                for own, ids in zip(part.column("_id").to_pylist(), encoder.encode(part.column("_text"))):
                    doc_ids.append(own)
                    held.append(ids)
                    size += len(ids)
                    if size >= BLOCK_IDS:
                        yield pa.RecordBatch.from_pylist([_pack(block, doc_ids, held, symbols, first, shard)], _BLOCK_SCHEMA)
                        block, first, size, doc_ids, held = block + 1, first + size, 0, [], []
        if held:
            yield pa.RecordBatch.from_pylist([_pack(block, doc_ids, held, symbols, first, shard)], _BLOCK_SCHEMA)

    rows = docs.select(F.col(doc_id).cast("long").alias("_id"), F.col(column).alias("_text"))
    return rows.repartitionByRange("_id").sortWithinPartitions("_id", "_text").mapInArrow(run, BLOCK)


def read_documents(blocks: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, decoded from its block."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                block = Block(row)
                docs = block.all()
                sizes = np.array([len(d) for d in docs], np.int64)
                starts = row["base"] + row["first_id"] + np.cumsum(sizes) - sizes
                crc = [zlib.crc32(d.tobytes()) for d in docs]
                yield pa.RecordBatch.from_arrays([pa.array(block.doc_ids, pa.int64()), pa.array(starts), pa.array(sizes),
                                                  pa.array(crc, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    # One row for each shard: where it starts.
    shards = blocks.groupBy("shard").agg(F.sum("n_ids").alias("total"))
    upto = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = shards.select(F.col("shard").alias("s_shard"), F.coalesce(F.sum("total").over(upto), F.lit(0)).alias("base"))
    placed = blocks.join(shards, F.col("shard") == F.col("s_shard")).drop("s_shard")
    return placed.mapInArrow(run, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def round_trip(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """Encodes and writes all documents, and reads every one back from the files."""
    if tokenizer is None:
        import public_tokenizers

        tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    scratch = Scratch(docs.sparkSession, "tokens")
    return read_documents(scratch.cut(encode_blocks(docs, tokenizer)))
