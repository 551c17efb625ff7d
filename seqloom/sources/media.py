"""Binary formats read and written by hand: sound font presets, standard MIDI files, WAV and FLAC headers.

The parsers work on bytes; ``*_table`` functions run them over ``binaryFile`` tables in Arrow
batches, one file at a time, so a worker holds one file and its rows.
"""

from __future__ import annotations

import hashlib
import io
import struct
import wave
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F


def presets(data: bytes) -> list[tuple[int, int, str]] | None:
    """(bank, patch, name) of a sound font's presets; None if it isn't a readable one."""
    if len(data) < 12 or data[:4] != b"RIFF" or data[8:12] != b"sfbk":
        return None

    def chunks(at: int, end: int) -> Iterator[tuple[bytes, int, int]]:
        while at + 8 <= end:
            tag, size = data[at : at + 4], int.from_bytes(data[at + 4 : at + 8], "little")
            yield tag, at + 8, min(at + 8 + size, end)
            at += 8 + size + size % 2

    for tag, a, b in chunks(12, len(data)):
        if tag == b"LIST" and data[a : a + 4] == b"pdta":
            for inner, c, d in chunks(a + 4, b):
                if inner == b"phdr":
                    n = (d - c) // 38
                    rows = [struct.unpack_from("<20sHH", data, c + 38 * k) for k in range(n)][:-1]  # the last ends the list
                    return [(bank, patch, name.split(b"\0")[0].decode("latin-1")) for name, patch, bank in rows]
    return None


def _number(n: int) -> bytes:
    """Variable-length quantity."""
    out = [n & 127]
    while n := n >> 7:
        out.append(n & 127 | 128)
    return bytes(reversed(out))


def midi_track(events: list[tuple[int, bytes]], name: str | None = None) -> bytes:
    """One track of (tick, message) in order."""
    parts, before = [], 0
    if name is not None:
        text = name.encode("latin-1", "replace")
        parts.append(b"\0\xff\x03" + _number(len(text)) + text)
    for tick, message in events:
        parts += (_number(tick - before), message)
        before = tick
    body = b"".join([*parts, b"\0\xff\x2f\0"])
    return b"MTrk" + struct.pack(">I", len(body)) + body


def midi_file(tracks: list[bytes], ppq: int) -> bytes:
    return b"MThd" + struct.pack(">IHHH", 6, 1, len(tracks), ppq) + b"".join(tracks)


def midi_messages(data: bytes) -> tuple[int, list[tuple[int, int, int, int, int, bytes]]]:
    """ppq and (track, tick, status, d1, d2, payload) of all messages; meta events have status 0xFF and their kind in d1."""
    if data[:4] != b"MThd":
        raise ValueError("not a MIDI file")
    ppq, at, track, out = struct.unpack(">H", data[12:14])[0], 8 + struct.unpack(">I", data[4:8])[0], 0, []

    def quantity(at: int) -> tuple[int, int]:
        n = 0
        while True:
            b = data[at]
            n, at = n << 7 | b & 127, at + 1
            if b < 128:
                return n, at

    while at + 8 <= len(data):
        tag, size = data[at : at + 4], struct.unpack(">I", data[at + 4 : at + 8])[0]
        at, end = at + 8, at + 8 + size
        if tag == b"MTrk":
            tick, status = 0, 0
            while at < end:
                delta, at = quantity(at)
                tick += delta
                if data[at] >= 128:
                    status, at = data[at], at + 1
                if status in (0xFF, 0xF0, 0xF7):
                    kind = 0
                    if status == 0xFF:
                        kind, at = data[at], at + 1
                    n, at = quantity(at)
                    out.append((track, tick, status, kind, 0, data[at : at + n]))
                    at += n
                else:
                    two = status & 0xF0 not in (0xC0, 0xD0)
                    out.append((track, tick, status, data[at], data[at + 1] if two else 0, b""))
                    at += 1 + two
            track += 1
        at = end
    return ppq, out


def audio_info(data: bytes) -> dict:
    """channels, sample_rate, bits, frames, silent (None: unknown) of WAV or FLAC bytes; {} if neither."""
    if data[:4] == b"RIFF":
        with wave.open(io.BytesIO(data)) as w:
            frames = w.readframes(w.getnframes())
            return {"channels": w.getnchannels(), "sample_rate": w.getframerate(), "bits": 8 * w.getsampwidth(), "frames": w.getnframes(), "silent": not any(frames)}
    if data[:4] == b"fLaC":
        v = int.from_bytes(data[18:26])
        rate, channels, bits, frames, digest = v >> 44, (v >> 41 & 7) + 1, (v >> 36 & 31) + 1, v & (1 << 36) - 1, data[26:42]
        # the digest is that of the decoded samples: compare with that of as many zeros
        zeros, left = hashlib.md5(), frames * channels * ((bits + 7) // 8)
        while left > 0:
            zeros.update(bytes(min(left, 1 << 20)))
            left -= 1 << 20
        return {"channels": channels, "sample_rate": rate, "bits": bits, "frames": frames, "silent": (zeros.digest() == digest or not frames) if any(digest) else None}
    return {}


def wav_mono(data: bytes) -> tuple[np.ndarray, int]:
    """Samples (mean over channels, -1 to 1) and rate of a 16-bit WAV."""
    with wave.open(io.BytesIO(data)) as w:
        if w.getsampwidth() != 2:
            raise ValueError("only 16-bit WAV is read")
        x = np.frombuffer(w.readframes(w.getnframes()), "<i2").astype(np.float32) / 32768
        return x.reshape(-1, w.getnchannels()).mean(1), w.getframerate()


def mixed(stems: list[np.ndarray], peak_db: float = -1.0) -> np.ndarray:
    """Sum of stems of any lengths, scaled to a peak."""
    total = np.zeros(max(map(len, stems), default=0), np.float32)
    for s in stems:
        total[: len(s)] += s
    peak = float(np.abs(total).max()) if len(total) else 0.0
    return total * np.float32(10 ** (peak_db / 20) / peak) if peak else total


def wav_bytes(samples: np.ndarray, rate: int) -> bytes:
    """Mono 16-bit WAV; clipped, then cut (not rounded) to integers."""
    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(1)
        w.setsampwidth(2)
        w.setframerate(rate)
        w.writeframes((np.clip(samples, -1, 1) * 32767).astype("<i2").tobytes())
    return out.getvalue()


MESSAGE = {"track": pa.int32(), "tick": pa.int64(), "status": pa.int32(), "d1": pa.int32(), "d2": pa.int32(), "payload": pa.binary()}


def _table(files: DataFrame, schema: str, rows_of: Callable[[str, bytes], list[tuple]]) -> DataFrame:
    names = [c.split(" ")[0] for c in schema.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"], strict=True):
                yield pd.DataFrame(rows_of(path, bytes(content)), columns=names)

    return files.select("path", "content").mapInPandas(run, schema)


def presets_table(files: DataFrame) -> DataFrame:
    """path, bank, patch, name; an unreadable font has no rows."""
    return _table(files, "path string, bank int, patch int, name string", lambda p, b: [(p, *x) for x in presets(b) or []])


def midi_table(files: DataFrame) -> DataFrame:
    """path, ppq, track, tick, status, d1, d2, payload of all messages."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(*batch.columns, strict=True):
                if data := content.as_py():
                    ppq, messages = midi_messages(data)
                    own = list(zip(*messages, strict=True)) or [()] * len(MESSAGE)
                    n = len(messages)
                    yield pa.RecordBatch.from_arrays([pa.array([path.as_py()] * n, pa.string()), pa.array([ppq] * n, pa.int32()), *map(pa.array, own, MESSAGE.values())], ["path", "ppq", *MESSAGE])

    return files.select("path", "content").mapInArrow(run, "path string, ppq int, track int, tick long, status int, d1 int, d2 int, payload binary")


def audio_table(files: DataFrame) -> DataFrame:
    """path, channels, sample_rate, bits, frames, silent, sha256."""
    keys = ("channels", "sample_rate", "bits", "frames", "silent")

    def row(path: str, data: bytes) -> list[tuple]:
        info = audio_info(data)
        return [(path, *(info.get(k) for k in keys), hashlib.sha256(data).hexdigest())]

    return _table(files, "path string, channels int, sample_rate int, bits int, frames long, silent boolean, sha256 string", row)


def digests(files: DataFrame) -> DataFrame:
    return files.select("path", F.sha2("content", 256).alias("sha256"))
