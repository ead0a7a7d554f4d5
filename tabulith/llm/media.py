"""Telephony audio columns: G.711 mu-law and A-law, IMA ADPCM, and resampled PCM.

mu-law and A-law samples are expanded by tables of 256 entries, made from the companding rules. IMA
ADPCM blocks are decoded side by side: one numpy step decodes the same nibble of every block. Audio
is resampled by an integer factor with linear interpolation, over a whole batch of clips at once.
A stored clip is a RIFF/WAVE file in a binary column; so is its PCM.

Edges: a null text is stored as an empty one; an empty payload is stored as one unit of padding;
equal texts give equal values; repeated rows each get theirs; keys keep their type and may be null; an empty table
gives an empty result; other columns are left out, whatever their names. A long text is one clip, and its PCM up to
7.3 times as long, so that a text may have 290 MB at most (a value of 2 GB is Spark's limit); clips are taken in
groups of a bounded number of bytes.
"""

from __future__ import annotations

import hashlib
import struct
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabulith.llm.common import discard, small_batches, stored

MULAW, ALAW, IMA, PCM = 7, 6, 17, 1
UNIT, PAD, RATE, FACTOR = 576, 255, 8000, 2
#: Bytes of clips that are decoded side by side; a longer clip is decoded by itself.
GROUP = 1 << 20
#: Bytes of an IMA block here: 4 of header (a sample, a step index) and 32 of nibbles.
IMA_BLOCK = 36


def mulaw_table() -> np.ndarray:
    """G.711: inverted bits, sign, three bits of exponent, four of mantissa, bias 132."""
    u = ~np.arange(256, dtype=np.int32) & 0xFF
    size = (((u & 0x0F) << 3) + 132 << (u >> 4 & 7)) - 132
    return np.where(u & 0x80, -size, size).astype(np.int16)


def alaw_table() -> np.ndarray:
    """G.711: every other bit inverted, sign, three bits of exponent, four of mantissa."""
    a = np.arange(256, dtype=np.int32) ^ 0x55
    exponent, size = a >> 4 & 7, (a & 0x0F) << 4
    size = np.where(exponent == 0, size + 8, size + 0x108 << np.maximum(exponent - 1, 0))
    return np.where(a & 0x80, size, -size).astype(np.int16)


def ima_steps() -> np.ndarray:
    """89 quantiser steps of the IMA recommendation: 7, growing by a tenth, as the recommendation rounds them."""
    # fixed values of the IMA ADPCM recommendation
    return np.array(
        [
            7, 8, 9, 10, 11, 12, 13, 14, 16, 17, 19, 21, 23, 25, 28, 31, 34, 37, 41, 45, 50, 55, 60, 66, 73, 80, 88, 97, 107, 118,
            130, 143, 157, 173, 190, 209, 230, 253, 279, 307, 337, 371, 408, 449, 494, 544, 598, 658, 724, 796, 876, 963, 1060, 1166,
            1282, 1411, 1552, 1707, 1878, 2066, 2272, 2499, 2749, 3024, 3327, 3660, 4026, 4428, 4871, 5358, 5894, 6484, 7132, 7845,
            8630, 9493, 10442, 11487, 12635, 13899, 15289, 16818, 18500, 20350, 22385, 24623, 27086, 29794, 32767,
        ],
        dtype=np.int32,
    )


MULAW_TABLE, ALAW_TABLE, STEPS = mulaw_table(), alaw_table(), ima_steps()
INDEX_MOVES = np.array([-1, -1, -1, -1, 2, 4, 6, 8], dtype=np.int32)
_moves = np.clip(np.arange(89)[:, None] + np.tile(INDEX_MOVES, 2)[None, :], 0, 88)
_sizes = (STEPS[:, None] >> 3) + sum(((np.arange(16)[None, :] >> b & 1) * (STEPS[:, None] >> 2 - b)) for b in range(3))
#: By step index * 16 + nibble: the change of the sample, and the next step index * 16.
DELTAS = np.where(np.arange(16)[None, :] & 8, -_sizes, _sizes).astype(np.int32).reshape(-1)
NEXT = (_moves * 16).astype(np.int32).reshape(-1)


def decode_ima(blocks: np.ndarray) -> np.ndarray:
    """blocks x bytes (mono; header, then nibbles, low one first) -> blocks x samples, int16."""
    n, width = blocks.shape
    out = np.empty((1 + 2 * (width - 4), n), dtype=np.int16)
    held = blocks[:, 0].astype(np.int32) | blocks[:, 1].astype(np.int32) << 8
    sample = np.where(held >= 1 << 15, held - (1 << 16), held).astype(np.int32)
    index = np.minimum(blocks[:, 2], 88).astype(np.int32) * 16
    out[0] = sample
    across = np.ascontiguousarray(blocks[:, 4:].T)
    for j in range(width - 4):
        for k, code in enumerate((across[j] & 15, across[j] >> 4)):
            at = index + code
            sample = sample + DELTAS[at]
            np.maximum(sample, -32768, out=sample)
            np.minimum(sample, 32767, out=sample)
            index = NEXT[at]
            out[1 + 2 * j + k] = sample
    return np.ascontiguousarray(out.T)


def resample(pcm: np.ndarray, ends: np.ndarray, factor: int = FACTOR) -> np.ndarray:
    """factor samples for each one, linear between it and its successor; a clip's last sample (before each of ends) is held."""
    after = np.empty_like(pcm)
    after[:-1] = pcm[1:]
    after[ends - 1] = pcm[ends - 1]
    out = np.empty((len(pcm), factor), dtype=np.int16)
    gap = after.astype(np.int32) - pcm
    for k in range(factor):
        out[:, k] = pcm + (gap * k) // factor
    return out.reshape(-1)


def to_wave(payload: bytes, format_: int, rate: int = RATE, block: int = 1) -> bytes:
    """A mono RIFF/WAVE file that holds payload as its samples."""
    bits = {MULAW: 8, ALAW: 8, IMA: 4, PCM: 16}[format_]
    per_block = 1 + 2 * (block - 4) if format_ == IMA else 1
    speed = rate * block // per_block
    form = struct.pack("<HHIIHHH", format_, 1, rate, speed, block, bits, 2 if format_ == IMA else 0) + (struct.pack("<H", per_block) if format_ == IMA else b"")
    count = len(payload) // block * per_block
    chunks = b"".join(name + struct.pack("<I", len(body)) + body for name, body in ((b"fmt ", form), (b"fact", struct.pack("<I", count)))) + b"data" + struct.pack("<I", len(payload))
    tail = payload + b"\0" * (len(payload) % 2)
    return b"RIFF" + struct.pack("<I", 4 + len(chunks) + len(tail)) + b"WAVE" + chunks + tail


def from_wave(wave: bytes) -> tuple[int, int, int, memoryview]:
    """(format, rate, block, payload) of a mono RIFF/WAVE file."""
    view = memoryview(wave)
    if len(view) < 12 or view[:4] != b"RIFF" or view[8:12] != b"WAVE":
        raise ValueError("no RIFF/WAVE file")
    at, form = 12, None
    while at + 8 <= len(view):
        name, (n,) = bytes(view[at : at + 4]), struct.unpack_from("<I", view, at + 4)
        if name == b"fmt ":
            format_, channels, rate, _, block = struct.unpack_from("<HHIIH", view, at + 8)
            if channels != 1:
                raise ValueError("only mono telephony is read")
            form = (format_, rate, block)
        elif name == b"data" and form:
            return (*form, view[at + 8 : at + 8 + n])
        at += 8 + n + n % 2
    raise ValueError("no samples")


def decode(wave: bytes) -> tuple[int, np.ndarray]:
    """(rate, int16 samples) of a mu-law, A-law, IMA ADPCM or 16-bit PCM file; a last partial ADPCM block is left out."""
    format_, rate, block, payload = from_wave(wave)
    raw = np.frombuffer(payload, dtype=np.uint8)
    if format_ == MULAW:
        return rate, MULAW_TABLE[raw]
    if format_ == ALAW:
        return rate, ALAW_TABLE[raw]
    if format_ == PCM:
        return rate, raw[: len(raw) // 2 * 2].view("<i2")
    if format_ == IMA and block > 4:
        return rate, decode_ima(raw[: len(raw) // block * block].reshape(-1, block)).reshape(-1)
    raise ValueError(f"format {format_} is not telephony audio")


def padded(body: bytes) -> bytes:
    return body + bytes([PAD]) * (max(1, -(-len(body) // UNIT)) * UNIT - len(body))


#: Formats in which texts are stored, by the CRC-32 of the text, with their blocks of bytes.
CODECS = ((MULAW, 1), (ALAW, 1), (IMA, IMA_BLOCK))
NAMES = {MULAW: "mulaw", ALAW: "alaw", IMA: "ima"}


def as_clip(body: bytes) -> bytes:
    """A text's bytes, padded, as the samples of a RIFF/WAVE file: by the text, as mu-law, A-law or IMA ADPCM blocks. The payload is the same bytes in each."""
    format_, block = CODECS[zlib.crc32(body) % len(CODECS)]
    return to_wave(padded(body), format_, RATE, block)


def store_as_audio(rows: DataFrame, text: Column, key: str) -> DataFrame:
    """key (of its own type), n_bytes and media: the text's UTF-8 bytes as a clip."""

    def encoded(batches):
        for batch in batches:
            bodies = batch.column("body")
            sizes = np.cumsum(pc.binary_length(bodies).to_numpy(zero_copy_only=False))
            for at, to in _groups(sizes):
                part = batch.slice(at, to - at)
                clips = pa.array([as_clip(x.encode()) for x in part.column("body").to_pylist()], pa.binary())
                yield pa.RecordBatch.from_arrays([part.column("key"), part.column("n_bytes"), clips], names=["key", "n_bytes", "media"])

    body = F.coalesce(text, F.lit(""))
    shaped = small_batches(rows).select(F.col(key).alias("key"), F.octet_length(body).cast("long").alias("n_bytes"), body.alias("body"))
    return shaped.mapInArrow(encoded, f"key {_kind(shaped)}, n_bytes long, media binary")


FEATURES = "n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"


def _kind(df: DataFrame) -> str:
    return df.schema["key"].dataType.simpleString()


def _groups(sizes: np.ndarray):
    """Rows at ... to - 1 of about GROUP bytes together; sizes are cumulated."""
    at = 0
    while at < len(sizes):
        base = sizes[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(sizes, base + GROUP, side="right")))
        yield at, to
        at = to


def _sums(values: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    return np.add.reduceat(values, cuts[:-1], dtype=np.int64)


def _expanded(format_: int, raw: np.ndarray) -> tuple[np.ndarray, int, int]:
    """Samples of payloads that lie one after another, and how many samples (num) so many bytes (den) make."""
    if format_ == IMA:
        return decode_ima(raw.reshape(-1, IMA_BLOCK)).reshape(-1), 1 + 2 * (IMA_BLOCK - 4), IMA_BLOCK
    return (MULAW_TABLE if format_ == MULAW else ALAW_TABLE)[raw], 1, 1


def _features(waves: list[bytes]) -> list[tuple]:
    """What the stored clips hold, how they sound expanded and resampled, and that sound as a 16-bit PCM file; clips of a format side by side."""
    clips = [from_wave(w) for w in waves]
    out: list[tuple] = [()] * len(waves)
    for format_, _ in CODECS:
        own = [i for i, c in enumerate(clips) if c[0] == format_]
        if not own:
            continue
        payloads = [bytes(clips[i][3]) for i in own]
        samples, num, den = _expanded(format_, np.frombuffer(b"".join(payloads), dtype=np.uint8))
        cuts = np.concatenate([[0], np.cumsum([len(p) for p in payloads])]).astype(np.int64) // den * num
        pcm = resample(samples, cuts[1:])
        wide = cuts * FACTOR
        energy = _sums(pcm.astype(np.int64) ** 2, wide)
        turns = np.append((pcm[1:] < 0) != (pcm[:-1] < 0), False)
        turns[wide[1:] - 1] = False
        crossings = _sums(turns, wide)
        for k, i in enumerate(own):
            sound = pcm[wide[k] : wide[k + 1]]
            body = sound.astype("<i2").tobytes()
            feature = f"{NAMES[format_]}:pcm{RATE * FACTOR}:{zlib.crc32(body):08x} energy:{energy[k]} crossings:{crossings[k]} peak:{int(np.abs(sound.astype(np.int32)).max())}"
            payload, wave = payloads[k], waves[i]
            out[i] = (len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]), len(wave), hashlib.sha256(wave).hexdigest(), feature, to_wave(body, PCM, RATE * FACTOR, 2))
    return out


def audio_features(clips: DataFrame, pcm: bool = False) -> DataFrame:
    """Read stored clips back: digests of payload and file, and features of the expanded and resampled audio; with pcm, that audio too, as 16-bit PCM files."""
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.binary()]
    names = ["key", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "pcm"]

    def measured(batches):
        for batch in batches:
            sizes = np.cumsum(pc.binary_length(batch.column("media")).to_numpy(zero_copy_only=False))
            for at, to in _groups(sizes):
                part = batch.slice(at, to - at)
                cols = list(zip(*_features(part.column("media").to_pylist()), strict=True))
                made = [part.column("key"), part.column("n_bytes"), *[pa.array(c, k) for c, k in zip(cols, kinds, strict=True)]]
                yield pa.RecordBatch.from_arrays(made if pcm else made[:-1], names=names if pcm else names[:-1])

    return small_batches(clips).mapInArrow(measured, f"key {_kind(clips)}, {FEATURES}" + (", pcm binary" if pcm else ""))


#: Passes in which clips are stored, read back and resampled: at most one pass's clips are on disk beside the PCM.
ROUNDS = 8
#: Level of zstd for PCM, which is four to seven times its clip before compression.
PCM_LEVEL = "12"


def store_media(rows: DataFrame, text: Column, key: str, rounds: int = ROUNDS) -> DataFrame:
    """Store every text as a clip, read the clips back, and store their resampled PCM with what audio_features measures; read from that store, with pcm.

    A pass takes the rows of a share of hashes; its clips are deleted when their PCM is stored. Every row is in one pass."""
    share = F.pmod(F.xxhash64(F.col(key), text), F.lit(rounds))
    made = []
    for k in range(rounds):
        clips = stored(store_as_audio(rows.filter(share == k), text, key), "media-clips")
        made.append(stored(audio_features(clips, pcm=True), "media-pcm", **{"parquet.compression.codec.zstd.level": PCM_LEVEL}))
        discard(clips)
    out = made[0]
    for more in made[1:]:
        out = out.unionByName(more)
    return out


def resampled_pcm(clips: DataFrame, media: str = "media", factor: int = FACTOR) -> DataFrame:
    """clips with media replaced by 16-bit PCM files at factor times the rate; null stays null."""

    def converted(batches):
        for batch in batches:
            out = []
            for wave in batch.column(media).to_pylist():
                if wave is None:
                    out.append(None)
                    continue
                rate, pcm = decode(wave)
                up = resample(pcm, np.array([len(pcm)]), factor) if len(pcm) else pcm
                out.append(to_wave(up.astype("<i2").tobytes(), PCM, rate * factor, 2))
            yield batch.set_column(batch.schema.get_field_index(media), media, pa.array(out, pa.binary()))

    return small_batches(clips).mapInArrow(converted, clips.schema)
