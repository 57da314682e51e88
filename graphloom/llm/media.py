"""Media columns: AVI with motion-JPEG frames.

A payload is stored as grey baseline JPEG frames in an AVI file: a byte is one
quantised coefficient (quantiser 1), 64 bytes one 8 x 8 block, so nothing is lost.
Each coefficient has size 8: one code bit and eight value bits, all 256 values
possible; a restart follows every block. The reader takes the RIFF chunks and
index apart, decodes the intra frames (any Huffman tables, grey or the luma of colour frames),
and gives coefficients, pixels, histograms and timed clips. A shot begins where the
difference of two frames' histograms is far above those just before.

Defined results: a null text is an empty one and an empty payload is one block of
zeros; equal payloads give equal files and features (all sums are of whole numbers);
null media give null results, and bytes that are no such file, or a broken one, give null payload, feature and clips beside their size
and hash; files of any frame sizes may stand side by side; an empty table stays empty; other columns are carried, but for those with the name of a
result, which it replaces. An AVI file's sizes have 32 bits: a text of more than about 3 GB is an error.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK = 64
SIDE, PER_FRAME = 32, 16
FPS = 25
BINS = 16
#: A cut needs a difference this many standard deviations above the mean of the last SHOT_SPAN that were no cuts, and this share of the pixels.
SHOT_SPAN, SHOT_SIGMA, SHOT_LEAST = 8, 3.0, 0.25
_SOME_BYTES = 4 << 20

# fixed values of the JPEG format: place of the k-th coefficient of the zigzag order in a block of rows
ZIGZAG = sorted(range(64), key=lambda i: (i // 8 + i % 8, (i // 8 if (i // 8 + i % 8) % 2 else i % 8)))


def _basis() -> np.ndarray:
    """(64 zigzag coefficients, 64 pixels) inverse cosine transform, in whole 1024ths: sums stay exact in 32-bit floats."""
    n = np.arange(8)
    one = np.cos((2 * n[None, :] + 1) * n[:, None] * np.pi / 16) * np.where(n == 0, np.sqrt(0.5), 1)[:, None] / 2
    both = np.einsum("ux,vy->uvxy", one, one).reshape(64, 64)
    return np.rint(both[ZIGZAG] * 1024).astype(np.float32)


BASIS = _basis()


def _segment(marker: int, body: bytes) -> bytes:
    return struct.pack(">BBH", 0xFF, marker, len(body) + 2) + body


def _frame_head() -> bytes:
    return (
        b"\xff\xd8"
        + _segment(0xDB, b"\0" + b"\1" * 64)
        + _segment(0xC0, struct.pack(">BHHB3B", 8, SIDE, SIDE, 1, 1, 0x11, 0))
        + _segment(0xC4, b"\x00" + b"\1" + b"\0" * 15 + b"\x08")  # one code of one bit: size 8
        + _segment(0xC4, b"\x10" + b"\1" + b"\0" * 15 + b"\x08")  # one code of one bit: no zeros, then size 8
        + _segment(0xDD, struct.pack(">H", 1))
        + _segment(0xDA, b"\1\1\0\0\x3f\0")
    )


HEAD = _frame_head()


def _coded(blocks: np.ndarray) -> np.ndarray:
    """(n, 64) bytes -> (n, 72): each byte's 8 bits behind a 0 bit."""
    b = blocks.reshape(-1, 8).astype(np.uint16)
    out = np.empty((len(b), 9), np.uint8)
    for k in range(8):
        before = (b[:, k - 1] << (8 - k)) if k else 0
        out[:, k] = (before | (b[:, k] >> (k + 1))) & 0xFF
    out[:, 8] = b[:, 7]
    return out.reshape(-1, 72)


def _decoded(coded: np.ndarray) -> np.ndarray:
    """(n, 72) -> (n, 64) bytes."""
    c = coded.reshape(-1, 9).astype(np.uint16)
    out = np.empty((len(c), 8), np.uint8)
    for k in range(8):
        out[:, k] = ((c[:, k] << (k + 1)) | (c[:, k + 1] >> (7 - k))) & 0xFF
    return out.reshape(-1, 64)


def _chunk(name: bytes, body: bytes) -> bytes:
    return name + struct.pack("<I", len(body)) + body + b"\0" * (len(body) % 2)


def _frames(blocks: np.ndarray) -> list[bytes]:
    """JPEG frames of whole multiples of PER_FRAME coded blocks."""
    n = len(blocks) // PER_FRAME
    coded = _coded(blocks)
    restarts = np.array([[0xFF, 0xD0 + i % 8] for i in range(PER_FRAME)], np.uint8)
    body = np.concatenate([coded.reshape(n, PER_FRAME, 72), np.broadcast_to(restarts, (n, PER_FRAME, 2))], axis=2).reshape(n, -1)[:, :-2]
    tail = [b"\xff\xd9"]
    stuffed = (coded == 0xFF).any(axis=1).reshape(n, PER_FRAME).any(axis=1)
    out = []
    for i in range(n):
        if stuffed[i]:
            parts = [coded[i * PER_FRAME + j].tobytes().replace(b"\xff", b"\xff\0") + restarts[j].tobytes() * (j < PER_FRAME - 1) for j in range(PER_FRAME)]
            out.append(b"".join([HEAD, *parts, *tail]))
        else:
            out.append(b"".join([HEAD, body[i].tobytes(), *tail]))
    return out


def _avi(frames: list[bytes], payload_bytes: int) -> bytes:
    most = max(map(len, frames))
    avih = struct.pack("<14I", 1_000_000 // FPS, most * FPS, 0, 0x10, len(frames), 0, 1, most, SIDE, SIDE, 0, 0, 0, 0)
    strh = b"vidsMJPG" + struct.pack("<IHHIIIIIIII4H", 0, 0, 0, 0, 1, FPS, 0, len(frames), most, 10000, 0, 0, 0, SIDE, SIDE)
    strf = struct.pack("<IiiHH4sIiiII", 40, SIDE, SIDE, 1, 24, b"MJPG", SIDE * SIDE * 3, 0, 0, 0, 0)
    hdrl = _chunk(b"LIST", b"hdrl" + _chunk(b"avih", avih) + _chunk(b"LIST", b"strl" + _chunk(b"strh", strh) + _chunk(b"strf", strf)))
    info = _chunk(b"LIST", b"INFO" + _chunk(b"ICMT", b"%d\0" % payload_bytes))
    index, at = [], 4
    for f in frames:
        index.append(b"00dc" + struct.pack("<III", 0x10, at, len(f)))
        at += 8 + len(f) + len(f) % 2
    movi = _chunk(b"LIST", b"movi" + b"".join(_chunk(b"00dc", f) for f in frames))
    return _chunk(b"RIFF", b"AVI " + hdrl + info + movi + _chunk(b"idx1", b"".join(index)))


def padded(data: bytes) -> bytes:
    return data + b"\0" * (-len(data) % BLOCK if data else BLOCK)


def encode(payloads: list[bytes]) -> list[bytes]:
    """An AVI file for each payload of whole blocks; the last frame is filled up with zeros."""
    whole = [p + b"\0" * (-len(p) % (BLOCK * PER_FRAME)) for p in payloads]
    frames = _frames(np.frombuffer(b"".join(whole), np.uint8).reshape(-1, BLOCK))
    out, at = [], 0
    for p, w in zip(payloads, whole, strict=True):
        n = len(w) // (BLOCK * PER_FRAME)
        out.append(_avi(frames[at : at + n], len(p)))
        at += n
    return out


def riff(data: bytes, at: int, end: int) -> Iterator[tuple[bytes, int, int]]:
    """(name, from, to) of the chunks; a LIST's name is its kind."""
    while at + 8 <= end:
        name, size = data[at : at + 4], struct.unpack_from("<I", data, at + 4)[0]
        lo, hi = at + 8, min(at + 8 + size, end)
        yield (data[lo : lo + 4], lo + 4, hi) if name in (b"LIST", b"RIFF") else (name, lo, hi)
        at = hi + size % 2


def index(data: bytes) -> tuple[list[tuple[int, int]], int, int | None]:
    """Places (from, to) of the video frames, microseconds a frame, stored payload length if any."""
    _, lo, hi = next(riff(data, 0, len(data)))
    top = {name: (a, b) for name, a, b in riff(data, lo, hi)}
    head = {name: (a, b) for name, a, b in riff(data, *top[b"hdrl"])}
    micros = struct.unpack_from("<I", data, head[b"avih"][0])[0]
    said = next((int(data[a:b].rstrip(b"\0")) for name, a, b in riff(data, *top.get(b"INFO", (0, 0))) if name == b"ICMT" and data[a:b].rstrip(b"\0").isdigit()), None)
    base = top[b"movi"][0] - 4
    if b"idx1" in top:
        places = []
        for name, _, at, size in struct.iter_unpack("<4sIII", data[slice(*top[b"idx1"])]):
            if name[2:] in (b"dc", b"db"):
                places.append((base + at + 8, base + at + 8 + size))
    else:
        places = [(a, b) for name, a, b in riff(data, *top[b"movi"]) if name[2:] in (b"dc", b"db")]
    return places, micros, said


def _parse(frame: bytes) -> tuple[dict, bytes]:
    """A JPEG frame's tables and its entropy-coded part."""
    got, at = {"huff": {}, "quant": {}, "every": 0}, 2
    while True:
        marker, size = frame[at + 1], struct.unpack_from(">H", frame, at + 2)[0]
        body = frame[at + 4 : at + 2 + size]
        at += 2 + size
        if marker == 0xC4:
            while body:
                n = sum(body[1:17])
                got["huff"][body[0]] = (body[1:17], body[17 : 17 + n])
                body = body[17 + n :]
        elif marker == 0xDB:
            while body:
                wide = body[0] >> 4
                got["quant"][body[0] & 15] = np.frombuffer(body, ">u2" if wide else np.uint8, 64, 1)
                body = body[65 + 64 * wide :]
        elif marker == 0xC0:
            got["size"] = struct.unpack_from(">HH", body, 1)
            got["parts"] = [tuple(body[6 + 3 * i : 9 + 3 * i]) for i in range(body[5])]
        elif marker == 0xDD:
            got["every"] = struct.unpack(">H", body)[0]
        elif marker == 0xDA:
            got["scan"] = {body[1 + 2 * i]: body[2 + 2 * i] for i in range(body[0])}
            end = frame.rfind(b"\xff\xd9")
            return got, frame[at : end if end > 0 else len(frame)]


def _restarts(data: bytes) -> list[bytes]:
    """The scan between restarts, with stuffed zeros taken out."""
    x = np.frombuffer(data, np.uint8)
    at = np.flatnonzero((x[:-1] == 0xFF) & (x[1:] >= 0xD0) & (x[1:] <= 0xD7)) if len(x) else []
    cuts = [0, *(a for i in at for a in (i, i + 2)), len(data)]
    return [data[a:b].replace(b"\xff\0", b"\xff") for a, b in zip(cuts[::2], cuts[1::2], strict=True)]


def _codes(table: tuple[bytes, bytes]) -> dict[tuple[int, int], int]:
    """(length, code) -> symbol of a canonical Huffman table."""
    out, code, k = {}, 0, 0
    for length, n in enumerate(table[0], 1):
        for _ in range(n):
            out[length, code] = table[1][k]
            code, k = code + 1, k + 1
        code <<= 1
    return out


def _scan(tables: dict, data: bytes) -> np.ndarray:
    """Quantised coefficients of the first component, (blocks, 64) in zigzag order, in the order of the scan."""
    height, width = tables["size"]
    parts = tables["parts"]
    most_h, most_v = max(p[1] >> 4 for p in parts), max(p[1] & 15 for p in parts)
    units = -(-width // (8 * most_h)) * -(-height // (8 * most_v))
    codes = {k: _codes(t) for k, t in tables["huff"].items()}
    pieces = _restarts(data)
    every = tables["every"] or units
    out, unit = [], 0
    for piece in pieces:
        following, held, have = iter(piece), 0, 0
        last = [0] * len(parts)

        def take(n: int) -> int:
            """The next n bits; zeros behind the end."""
            nonlocal held, have
            while have < n:
                held, have = held << 8 | next(following, 0), have + 8
            have -= n
            out, held = held >> have, held & (1 << have) - 1
            return out

        def symbol(table: dict) -> int:
            code = 0
            for length in range(1, 17):
                code = code << 1 | take(1)
                if (length, code) in table:
                    return table[length, code]
            raise ValueError("no such code")

        def value(size: int) -> int:
            v = take(size)
            return v if not size or v >> (size - 1) else v - (1 << size) + 1

        for _ in range(min(every, units - unit)):
            for c, (name, factors, _) in enumerate(parts):
                pick = tables["scan"][name]
                for _ in range((factors >> 4) * (factors & 15) if len(parts) > 1 else 1):
                    block = np.zeros(64, np.int32)
                    last[c] += value(symbol(codes[pick >> 4]))
                    block[0], k = last[c], 1
                    while k < 64:
                        s = symbol(codes[0x10 | pick & 15])
                        if s == 0:
                            break
                        k += s >> 4
                        if s & 15 and k < 64:
                            block[k] = value(s & 15)
                        k += 1
                    if c == 0:
                        out.append(block)
            unit += 1
    return np.array(out).reshape(-1, 64)


_PLAIN = HEAD[2:]


def decode_frames(frames: list[bytes]) -> np.ndarray:
    """Coefficients (blocks, 64) of frames one after another. Frames with this module's tables are decoded together."""
    size = PER_FRAME * 74 - 2
    if all(len(f) == len(HEAD) + size + 2 and f.startswith(HEAD) for f in frames):
        body = np.frombuffer(b"".join(f[len(HEAD) : -2] + b"\0\0" for f in frames), np.uint8).reshape(-1, 74)
        return _signed(_decoded(np.ascontiguousarray(body[:, :72])))
    out = []
    for f in frames:
        if f.startswith(HEAD):
            coded = np.frombuffer(b"".join(_restarts(f[len(HEAD) : -2])), np.uint8).reshape(-1, 72)
            out.append(_signed(_decoded(coded)))
        else:
            tables, data = _parse(f)
            out.append(_scan(tables, data) * tables["quant"][tables["parts"][0][2]].astype(np.int32))
    return np.concatenate(out)


def _signed(values: np.ndarray) -> np.ndarray:
    """Size-8 value bits to coefficients: 128 to 255 stand for themselves, below that for v - 255."""
    v = values.astype(np.int16)
    return np.where(v >= 128, v, v - 255).astype(np.int16)


def _bytes(coefficients: np.ndarray) -> np.ndarray:
    return np.where(coefficients > 0, coefficients, coefficients + 255).astype(np.uint8)


def pixels(coefficients: np.ndarray) -> np.ndarray:
    """(blocks, 64) grey values 0 to 255; exact, as the transform adds whole numbers below 2**24."""
    return np.clip(np.floor(coefficients.astype(np.float32) @ BASIS / np.float32(1024)) + 128, 0, 255).astype(np.uint8)


def histograms(grey: np.ndarray, frame: np.ndarray, n: int) -> np.ndarray:
    """(n frames, BINS) counts of pixels; frame: each block's frame."""
    cell = frame[:, None] * BINS + (grey >> 4)
    return np.bincount(cell.ravel(), minlength=n * BINS).reshape(n, BINS)


def shots(hist: np.ndarray) -> list[int]:
    """First frames of the shots."""
    change = np.abs(np.diff(hist, axis=0)).sum(axis=1) / (2 * np.maximum(hist[1:].sum(axis=1), 1))
    cuts, calm = [0], []
    for i, c in enumerate(change.tolist()):
        before = np.array(calm[-SHOT_SPAN:])
        if c > SHOT_LEAST and (not calm or c > before.mean() + SHOT_SIGMA * before.std()):
            cuts.append(i + 1)
        else:
            calm.append(c)
    return cuts


def _parts(batch: pa.RecordBatch, column: str) -> Iterator[pa.RecordBatch]:
    """Slices of about _SOME_BYTES."""
    sizes = [len(x.as_buffer()) if x.is_valid else 0 for x in batch.column(column).cast(pa.binary())]
    lo, total = 0, 0
    for i, s in enumerate(sizes):
        if total and total + s > _SOME_BYTES:
            yield batch.slice(lo, i - lo)
            lo, total = i, 0
        total += s
    if len(sizes) > lo:
        yield batch.slice(lo)


def _encode_texts(batches):
    for batch in batches:
        for part in _parts(batch, "text"):
            data = [(t or "").encode() for t in part.column("text").to_pylist()]
            rest = [c for c in part.schema.names if c != "text"]
            media = encode([padded(d) for d in data])
            yield pa.record_batch([*(part.column(c) for c in rest), pa.array(map(len, data), pa.int64()), pa.array(media, pa.binary())], names=[*rest, "n_bytes", "media"])


def store_texts(docs: DataFrame) -> DataFrame:
    """``docs`` with ``n_bytes`` and ``media`` (an AVI file) in place of ``text``."""
    rest = docs.drop("text", "n_bytes", "media")
    fields = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in rest.schema.fields)
    return docs.select(*rest.columns, "text").mapInArrow(_encode_texts, f"{fields}n_bytes long, media binary")


RESULTS = ("payload", "feature", "clips", "media_bytes", "media_sha256")
CLIP = "struct<clip:int,start_s:double,end_s:double,frames:int>"


#: What bytes that are no such file, or a broken one, make the parts of the reader raise.
BROKEN = (ValueError, LookupError, ArithmeticError, TypeError, StopIteration, struct.error)


def _looked_up(media: bytes) -> tuple[list[bytes], int, int | None] | None:
    """(frames, microseconds a frame, payload bytes) of a file; None if it is broken."""
    try:
        places, micros, said = index(media)
        return [media[a:b] for a, b in places], micros, said
    except BROKEN:
        return None


def _alone(frames: list[bytes]) -> np.ndarray | None:
    """Coefficients of one file's frames, which are of one size; None if they are broken."""
    try:
        found = decode_frames(frames) if frames else None
        return found if found is not None and len(found) and len(found) % len(frames) == 0 else None
    except BROKEN:
        return None


def _described(media: bytes, n: int, micros: int, said: int | None, coefficients: np.ndarray) -> dict:
    """What is read from a file of n frames."""
    own = histograms(pixels(coefficients), np.repeat(np.arange(n), len(coefficients) // n), n)
    cuts = shots(own)
    clips = [{"clip": j, "start_s": a * micros / 1e6, "end_s": b * micros / 1e6, "frames": b - a} for j, (a, b) in enumerate(zip(cuts, [*cuts[1:], n], strict=True))]
    feature = f"frames={n};shots={len(cuts)};cuts={','.join(map(str, cuts))};hist={','.join(map(str, own.sum(axis=0).tolist()))}"
    return {"payload": _bytes(coefficients).tobytes()[:said], "feature": feature, "clips": clips}


def _read_media(batches):
    for batch in batches:
        for part in _parts(batch, "media"):
            media = part.column("media").to_pylist()
            rest = [c for c in part.schema.names if c != "media"]
            found = [None if m is None else _looked_up(m) for m in media]
            # files of this module's frames are decoded together, any other alone
            size = len(HEAD) + PER_FRAME * 74
            ours = [i for i, f in enumerate(found) if f and f[0] and all(len(x) == size and x.startswith(HEAD) for x in f[0])]
            every = decode_frames([x for i in ours for x in found[i][0]]) if ours else None
            read, at = {}, 0
            for i in ours:
                read[i] = every[at : at + len(found[i][0]) * PER_FRAME]
                at += len(read[i])
            out: list[dict | None] = []
            for i, (m, f) in enumerate(zip(media, found, strict=True)):
                coefficients = read.get(i) if i in read else _alone(f[0]) if f else None
                told = {} if coefficients is None else _described(m, len(f[0]), f[1], f[2], coefficients)
                out.append(None if m is None else {"payload": None, "feature": None, "clips": None, "media_bytes": len(m), "media_sha256": hashlib.sha256(m).hexdigest()} | told)
            clip = pa.list_(pa.struct([("clip", pa.int32()), ("start_s", pa.float64()), ("end_s", pa.float64()), ("frames", pa.int32())]))
            kinds = [("payload", pa.binary()), ("feature", pa.string()), ("clips", clip), ("media_bytes", pa.int64()), ("media_sha256", pa.string())]
            columns = [pa.array([o and o[c] for o in out], t) for c, t in kinds]
            yield pa.record_batch([*(part.column(c) for c in rest), *columns], names=[*rest, *(c for c, _ in kinds)])


def read_media(files: DataFrame) -> DataFrame:
    """``files`` with its ``media`` replaced by payload, feature, clips (array), media_bytes and media_sha256."""
    rest = files.drop("media", *RESULTS)
    fields = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in rest.schema.fields)
    schema = f"{fields}payload binary, feature string, clips array<{CLIP}>, media_bytes long, media_sha256 string"
    return files.select(*rest.columns, "media").mapInArrow(_read_media, schema)


def clips(files: DataFrame) -> DataFrame:
    """One row a clip: the other columns of ``files`` with clip, start_s, end_s, frames."""
    read = read_media(files)
    rest = files.drop("media", "clip", "start_s", "end_s", "frames", *RESULTS).columns
    return read.select(*rest, F.inline("clips"))
