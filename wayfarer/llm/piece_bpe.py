"""SentencePiece encoding and decoding with a BPE model file.

Method: a merge-type prefix table.  For BPE the encoding of a prefix is a prefix of
the encoding up to its last token, and tokens may stand side by side exactly if the
pair, encoded by itself, stays that pair.  So every prefix has one last token: an
automaton over the vocabulary names the pieces that end at a position, and the one
that is compatible with the last token of the prefix before it is stored.  The ids
are then recovered backwards, in time linear in the text.

Character pairs that no piece holds inside are boundaries no merge crosses.  Texts
are cut there into segments (before spaces, and before signs that no piece holds
behind a letter), and a task remembers those it has met (at most ``MEMORY`` of them).

Characters outside the vocabulary become their UTF-8 byte pieces (or the unknown
id, in a model without them).  Decoding joins pieces, reads runs of byte pieces as
UTF-8 (each bad byte as U+FFFD) and drops the space that encoding put in front.

Defined cases: a null text encodes like an empty one, to no ids; null ids decode to
an empty text; the other columns of a table pass through.  A task holds
one Arrow batch of texts and their ids, and the tables of the model.

Models: type BPE, identity normalisation, dummy prefix, no removal of extra spaces,
no user-defined or unused pieces; ``load`` refuses others.
"""

from __future__ import annotations

import gc
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType

from wayfarer.llm.common import small_batches

#: Fixed value: how the model's pieces write a space.
SPACE = "▁"
#: Words, segments and pairs a task remembers before it starts anew.
MEMORY = 400_000


def load(path: str) -> dict:
    """Pieces, scores and special ids of the model file at ``path``, read once on the driver (as large as its vocabulary)."""
    from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2
    proto = sentencepiece_model_pb2.ModelProto()
    with open(path, "rb") as f:
        proto.ParseFromString(f.read())
    kinds = proto.SentencePiece
    norm, trained = proto.normalizer_spec, proto.trainer_spec
    if (trained.model_type != trained.BPE or norm.precompiled_charsmap or not norm.add_dummy_prefix or norm.remove_extra_whitespaces
            or not norm.escape_whitespaces or trained.treat_whitespace_as_suffix
            or any(p.type in (kinds.USER_DEFINED, kinds.UNUSED) for p in proto.pieces)):
        raise ValueError(f"{path}: not a plain BPE model")
    model = {"pieces": [p.piece for p in proto.pieces],
             "scores": [p.score if p.type == kinds.NORMAL else None for p in proto.pieces],
             "bytes": [next((i for i, p in enumerate(proto.pieces) if p.type == kinds.BYTE and p.piece == f"<0x{b:02X}>"), -1)
                       for b in range(256)],
             "unknown": next(i for i, p in enumerate(proto.pieces) if p.type == kinds.UNKNOWN),
             "control": [i for i, p in enumerate(proto.pieces) if p.type == kinds.CONTROL]}
    if not trained.byte_fallback:
        model["bytes"] = []
    score = {p: s for p, s in zip(model["pieces"], model["scores"]) if s is not None}
    # characters inside pieces which are no pieces themselves take part in merges all the same
    model["tokens"] = [p for p in sorted(set(score) | {c for p in score for c in p})
                       if len(p) == 1 or _merge(p, score) == [p]]  # others never come out of a merge
    model["surface"] = SentencePieceProcessor(model_file=path).decode([model["unknown"]])
    return model


def _merge(text: str, score: dict) -> list[str]:
    """BPE by its definition, for short texts: the best pair (leftmost of equals) becomes one, until none is a piece."""
    parts = list(text)
    while True:
        best, at = None, -1
        for i in range(len(parts) - 1):
            s = score.get(parts[i] + parts[i + 1])
            if s is not None and (best is None or s > best):
                best, at = s, i
        if at < 0:
            return parts
        parts[at:at + 2] = [parts[at] + parts[at + 1]]


def encoder(model: dict) -> Callable[[str], list[int]]:
    """A function from a text to its ids."""
    import ahocorasick
    score = {p: s for p, s in zip(model["pieces"], model["scores"]) if s is not None}
    ids = {p: i for i, (p, s) in enumerate(zip(model["pieces"], model["scores"])) if s is not None}
    known = {c for p in score for c in p}
    tokens = model["tokens"]
    size = [len(p) for p in tokens]
    matches = ahocorasick.Automaton()
    for k, p in enumerate(tokens):
        matches.add_word(p, k)
    matches.make_automaton()

    def id_list(piece: str) -> list[int]:
        if piece in ids:
            return [ids[piece]]
        return [model["bytes"][b] for b in piece.encode("utf-8")] if model["bytes"] else [model["unknown"]]

    id_lists = [id_list(p) for p in tokens]
    pairs: dict = {}

    def compatible(left: int, right: int) -> bool:
        if len(pairs) >= MEMORY:
            pairs.clear()
        pair = [tokens[left], tokens[right]]
        good = pairs[left << 32 | right] = _merge(pair[0] + pair[1], score) == pair
        return good

    def segment(text: str) -> list[int]:
        last = [-1] * (len(text) + 1)  # last[i]: the last token of the first i characters
        for end, k in matches.iter(text):
            if last[end + 1] < 0:
                before = end + 1 - size[k]
                if before:
                    left = last[before]
                    if left < 0:
                        continue
                    good = pairs.get(left << 32 | k)
                    if good is None:
                        good = compatible(left, k)
                    if not good:
                        continue
                last[end + 1] = k
        way, at = [], len(text)
        while at:
            way.append(last[at])
            at -= size[last[at]]
        out = []
        for k in reversed(way):
            out += id_lists[k]
        return out

    inside = {(a, b) for p in score for a, b in zip(p, p[1:])}
    # closing: characters that no piece holds behind a letter, or behind a character that is not itself closing
    closing = {c for c in known - {SPACE} if not c.isalpha()}
    while loose := {b for a, b in inside if b in closing and a not in closing and a != SPACE}:
        closing -= loose
    letters, signs = ("".join(map(re.escape, sorted(c))) for c in (known - closing - {SPACE}, closing))
    parts = [f"[{signs}]*[{letters}]+", f"[{signs}]+"] if closing else [f"[{letters}]+"]
    spaced = all(a == SPACE or b != SPACE for a, b in inside)  # no merge crosses from a word to the next space
    if spaced:
        cut = re.compile("|".join([f"{SPACE}*{part}" for part in parts] + [f"{SPACE}+", "."]), re.S)
    else:
        cut = re.compile(f"[{letters}{signs}{SPACE}]+|.", re.S)
    segments: dict = {}
    words: dict = {}

    def keep(memory: dict, text: str, found: list[int]) -> None:
        if len(text) <= 64:
            if len(memory) >= MEMORY:
                memory.clear()
            memory[text] = found

    def run(text: str) -> list[int]:
        out: list = []
        for s in cut.findall(text):
            found = segments.get(s)
            if found is None:
                found = segment(s) if s[0] in known else id_list(s)
                keep(segments, s, found)
            out += found
        return out

    def encode(text: str) -> list[int]:
        if not text:
            return []
        if not spaced or text[0] == " " or "  " in text or SPACE in text:
            return run(SPACE + text.replace(" ", SPACE))
        out: list = []
        for w in text.split(" "):
            found = words.get(w)
            if found is None:
                found = run(SPACE + w)
                keep(words, w, found)
            out += found
        return out

    return encode


def decoder(model: dict) -> Callable[[list[int]], str]:
    """A function from ids to their text."""
    byte_of = {i: b for b, i in enumerate(model["bytes"]) if i >= 0}
    plain = [p.replace(SPACE, " ") for p in model["pieces"]]
    for i in model["control"]:
        plain[i] = ""
    plain[model["unknown"]] = model["surface"]
    silent = set(model["control"])
    quick = [chr(byte_of[i]) if i in byte_of and byte_of[i] < 128 else None if i in byte_of else p for i, p in enumerate(plain)]

    def read_bytes(run: bytes) -> str:
        out = []
        while run:
            try:
                return "".join(out) + run.decode("utf-8")
            except UnicodeDecodeError as e:
                out.append(run[:e.start].decode("utf-8") + "�")  # one mark per byte that starts no character
                run = run[e.start + 1:]
        return "".join(out)

    def decode(ids: list[int]) -> str:
        first = next((k for k, i in enumerate(ids) if i not in silent), None)
        if first is None:
            return ""
        cut = model["pieces"][ids[first]].startswith(SPACE)
        try:  # without bytes of longer characters
            return "".join(map(quick.__getitem__, ids))[cut:]
        except TypeError:
            pass
        out, run = [], bytearray()
        for i in ids:
            b = byte_of.get(i)
            if b is not None:
                run.append(b)
                continue
            if run:
                out.append(read_bytes(bytes(run)))
                run = bytearray()
            out.append(plain[i])
        if run:
            out.append(read_bytes(bytes(run)))
        return "".join(out)[cut:]

    return decode


def encode(text: Column, model: dict) -> Column:
    """Array of the ids of ``text``."""
    @F.arrow_udf(ArrayType(IntegerType(), False))
    def piece_ids(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        run = encoder(model)
        collecting = gc.isenabled()
        gc.disable()  # the tables hold no cycles, and a collector would walk them again and again
        try:
            for texts in batches:
                ends, flat = [0], []
                for t in texts:
                    flat += run(t.as_py() or "")
                    ends.append(len(flat))
                yield pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int32()))
        finally:
            if collecting:
                gc.enable()
    return piece_ids(text)


def decode_lists(model: dict) -> Callable[[pa.Array], pa.Array]:
    """A function from an array of id lists to their texts; a null list gives an empty text.

    The bytes of all pieces of a batch are laid out by one ``take``, and the texts are cut from them where
    the lists end.  The first piece of a text comes without the space that encoding put in front.  Batches in
    which a text begins with a control id, or bytes make no UTF-8, go through ``decoder`` text by text.
    """
    one_by_one = decoder(model)
    plain = [p.replace(SPACE, " ") for p in model["pieces"]]
    for i in model["control"]:
        plain[i] = ""
    plain[model["unknown"]] = model["surface"]
    parts = [p.encode("utf-8") for p in plain]
    for b, i in enumerate(model["bytes"]):
        if i >= 0:
            parts[i] = bytes([b])
    first = [t[1:].encode("utf-8") if p.startswith(SPACE) else b for p, t, b in zip(model["pieces"], plain, parts)]
    table, n = pa.array(parts + first, pa.binary()), len(parts)

    def joined(lists: pa.Array) -> pa.Array | None:
        sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
        flat = lists.flatten()
        if flat.null_count:
            return None
        ids = flat.to_numpy().copy()
        ends = np.append(0, np.cumsum(sizes, dtype=np.int64))
        heads = ends[:-1][sizes > 0]
        if len(ids) and (ids.min() < 0 or ids.max() >= n or np.isin(ids[heads], model["control"]).any()):
            return None
        ids[heads] += n
        laid = table.take(pa.array(ids))
        _, offsets, data = laid.buffers()
        cuts = np.frombuffer(offsets, np.int32, len(ids) + 1)[ends] if len(ids) else np.zeros(len(ends), np.int32)
        texts = pa.StringArray.from_buffers(len(lists), pa.py_buffer(cuts), data or pa.py_buffer(b""))
        try:
            texts.validate(full=True)
        except pa.ArrowInvalid:
            return None
        return texts

    def run(lists: pa.Array) -> pa.Array:
        texts = joined(lists)
        if texts is None:
            texts = pa.array([one_by_one(x.values.to_pylist() if x.is_valid else []) for x in lists], pa.string())
        return texts

    return run


def decode(ids: Column, model: dict) -> Column:
    """The text of an array of ids."""
    @F.arrow_udf(StringType())
    def piece_text(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        yield from map(decode_lists(model), batches)
    return piece_text(ids)


def encode_documents(docs: DataFrame, path: str) -> DataFrame:
    """``docs`` as a struct ``doc``, with the ``ids`` of its column ``text`` and the text ``decoded`` from them."""
    small_batches(docs.sparkSession)
    model = load(path)
    ids = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")).withColumn("ids", encode(F.col("doc.text"), model))
    return ids.withColumn("decoded", decode(F.col("ids"), model))


def digests(docs: DataFrame, path: str) -> DataFrame:
    """Per document the number of ids and SHA-256 digests of its ids (decimal, joined by commas) and of the decoded text."""
    return encode_documents(docs.select("doc_id", "text"), path).select(
        "doc.doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"))
