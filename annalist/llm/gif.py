"""Media columns: payloads stored as GIF frames, decoded frames, and colour histograms."""

from __future__ import annotations

import hashlib
import zlib
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annalist.llm.common import text_batches

SIDE = 24
UNIT = SIDE * SIDE
PAD = 255
DELAY = 4
#: Levels of each colour channel in the histogram feature.
LEVELS = 4
#: The palette of stored payloads: sample s is red s, green s * 7 mod 256, blue 255 - s.
PALETTE = np.stack([np.arange(256), np.arange(256) * 7 % 256, 255 - np.arange(256)], axis=1).astype(np.uint8)
FRAMES_A_BATCH = 4096
STREAMS_AT_ONCE = 1024
#: Stored bytes whose frames a task decodes at a time; one larger GIF is decoded by itself.
BYTES_AT_ONCE = 4 << 20
_EMPTY = np.zeros((0, 0), dtype=np.uint8)


class GifError(ValueError):
    """Bytes that are not a whole, well-formed GIF."""


@dataclass
class Frame:
    """One image of a GIF: its indices, and how and for how long it is shown.

    ``stream`` is the code stream, code size and shape of an image that is not decoded yet.
    """

    indices: np.ndarray
    palette: np.ndarray
    left: int = 0
    top: int = 0
    delay: int = 0
    disposal: int = 0
    transparent: int | None = None
    interlaced: bool = False
    stream: tuple[bytes, int, int, int] | None = None


@dataclass
class Gif:
    width: int
    height: int
    background: int = 0
    palette: np.ndarray | None = None
    loops: int | None = None
    frames: list[Frame] = field(default_factory=list)


@lru_cache(maxsize=64)
def _widths(codes: int, root: int) -> np.ndarray:
    """Bit widths of the codes that follow a clear code, the first included.

    The table has ``2**root + 2`` entries then; the first code adds none and each later one
    adds one, up to 4096 entries.
    """
    newest = np.minimum((1 << root) + 1 + np.arange(codes), 4095)
    return np.array([int(n).bit_length() for n in newest], dtype=np.int64)


def lzw_codes(data: bytes, root: int = 8) -> list[list[int]]:
    """Codes of indices below ``2**root``: a list for each run between clear codes."""
    clear = 1 << root
    runs, codes, table, free = [], [], {}, clear + 2
    values = iter(data)
    prefix = next(values, -1)
    for value in values:
        key = prefix << 8 | value
        code = table.get(key)
        if code is not None:
            prefix = code
            continue
        codes.append(prefix)
        prefix = value
        if free < 4095:
            table[key] = free
            free += 1
        else:
            runs.append([*codes, clear])
            codes, table, free = [], {}, clear + 2
    runs.append(codes + [prefix] * (prefix >= 0) + [clear + 1])
    return runs


def lzw_streams(images: list[bytes], root: int = 8) -> list[bytes]:
    """The LZW code streams of many images, without sub-blocks; bits are packed in bulk."""
    numbers, widths, counts = [], [], []
    for data in images:
        runs = lzw_codes(data, root)
        numbers.append([1 << root])
        numbers += runs
        widths += [[root + 1], *(_widths(len(r), root) for r in runs)]
        counts.append(1 + sum(map(len, runs)))
    if not counts:
        return []
    number, width = np.fromiter(chain.from_iterable(numbers), dtype=np.int64), np.concatenate(widths)
    ends, last = np.cumsum(width), np.cumsum(counts) - 1
    sizes = np.diff(np.concatenate([[0], ends[last]]))
    whole = (sizes + 7) // 8
    begin = np.concatenate([[0], np.cumsum(whole)])
    shift = np.repeat(8 * begin[:-1] - np.concatenate([[0], ends[last][:-1]]), counts)
    at = ends - width + shift
    value, byte = number << (at & 7), at >> 3
    packed = sum(np.bincount(byte + k, weights=value >> 8 * k & 255, minlength=begin[-1] + 3) for k in range(3))
    packed = packed.astype(np.uint8).tobytes()
    return [packed[i:j] for i, j in zip(begin[:-1].tolist(), begin[1:].tolist(), strict=True)]


def lzw_encode(data: bytes, root: int = 8) -> bytes:
    """The LZW code stream of one image."""
    return lzw_streams([data], root)[0]


def lzw_images(streams: list[bytes], root: int, size: int) -> list[bytes]:
    """The images of ``size`` indices of many code streams, decoded side by side.

    Code j of every stream is read at once. A code above the roots stands for what an earlier
    code gave and the byte after it, which is a stretch of the output; so only lengths are
    needed while reading, and bytes are then copied along their chains, in a logarithm of
    steps. Streams with a clear code inside, or in need of more codes than fill the table,
    and broken ones are decoded one at a time.
    """
    clear, end, most = 1 << root, (1 << root) + 1, min(size, 4094 - (1 << root)) + 1
    n = len(streams)
    text = np.frombuffer(b"".join(streams) + bytes(4), dtype=np.uint8).astype(np.int64)
    lengths = np.array([len(s) for s in streams], dtype=np.int64)
    begin = 8 * (np.cumsum(lengths) - lengths)
    widths = np.concatenate([[root + 1], _widths(most, root)])
    at = np.concatenate([[0], np.cumsum(widths)])
    codes = np.full((most, n), end, dtype=np.int64)
    spans, active = np.zeros((most, n), dtype=np.int64), np.ones(n, dtype=bool)
    rows, alone = np.arange(n), np.zeros(n, dtype=bool)
    for j in range(-1, most):
        bit = begin + at[j + 1]
        fits = at[j + 1] + widths[j + 1] <= 8 * lengths
        byte = np.where(fits, bit >> 3, 0)
        code = (text[byte] | text[byte + 1] << 8 | text[byte + 2] << 16) >> (bit & 7) & (1 << widths[j + 1]) - 1
        if j < 0:
            alone = ~fits | (code != clear)
            active = ~alone
            continue
        over = code - end - 1
        alone |= active & (~fits | (code == clear) | (over >= max(j, 0)))
        active &= ~alone & (code != end)
        if not active.any():
            break
        codes[j] = np.where(active, code, end)
        spans[j] = np.where(active, np.where(over >= 0, spans[np.clip(over, 0, most - 1), rows] + 1, 1), 0)
    total = spans.sum(axis=0)
    alone |= total < size
    codes, spans = codes.T, spans.T
    spans[alone] = 0
    total = spans.sum(axis=1)
    used = spans > 0
    flat, span = codes[used], spans[used]
    put = np.cumsum(span) - span
    where = np.zeros(spans.shape, dtype=np.int64)
    where[used] = put
    row = np.nonzero(used)[0]
    over = flat - end - 1
    source = np.where(over >= 0, where[row, np.maximum(over, 0)], -1)
    step = np.arange(int(span.sum())) - np.repeat(put, span)
    back = np.repeat(source, span)
    back = np.where(back >= 0, back + step, np.arange(len(back)))
    out = np.repeat(np.where(over < 0, flat, 0), span)
    while True:
        jumped = back[back]
        if np.array_equal(jumped, back):
            break
        back = jumped
    out = out[back].astype(np.uint8).tobytes()
    begin = np.cumsum(total) - total
    return [lzw_decode(streams[i], root, size) if alone[i] else out[begin[i] : begin[i] + size] for i in range(n)]


def lzw_decode(stream: bytes, root: int, size: int) -> bytes:
    """The ``size`` indices of a code stream.

    Widths follow from the number of codes since the last clear code, so codes are cut from
    the stream in bulk; the string table then is a list. Codes after the table is full add
    nothing, as the format has it. A stream that is too short or holds an impossible code
    raises ``GifError``.
    """
    clear, end = 1 << root, (1 << root) + 1
    bits = np.unpackbits(np.frombuffer(stream, dtype=np.uint8), bitorder="little")
    powers = 1 << np.arange(12)
    roots = [bytes([v]) for v in range(clear)] + [b"", b""]
    out, length, at, table, last, guess = [], 0, 0, list(roots), None, size + 2
    while True:
        widths = _widths(guess, root)
        ends = at + np.cumsum(widths)
        n = int(np.searchsorted(ends, len(bits), side="right"))
        starts = ends[:n] - widths[:n]
        taken = np.arange(12)[None, :] < widths[:n, None]
        places = np.minimum(starts[:, None] + np.arange(12)[None, :], max(0, len(bits) - 1))
        codes = (bits[places].astype(np.int64) * powers * taken).sum(axis=1) if n else np.zeros(0, dtype=np.int64)
        stops = np.flatnonzero((codes == clear) | (codes == end))
        upto = int(stops[0]) if len(stops) else n
        for code in codes[:upto].tolist():
            if code < len(table):
                text = table[code]
                if last is not None and len(table) < 4096:
                    table.append(last + text[:1])
            elif code == len(table) and last is not None and len(table) < 4096:
                text = last + last[:1]
                table.append(text)
            else:
                raise GifError("impossible code")
            out.append(text)
            length += len(text)
            last = text
        if length >= size or (len(stops) and codes[upto] == end):
            break
        if not len(stops):
            if n < len(widths):
                raise GifError("code stream ends early")
            guess *= 4
            if guess > 64 * size + 65536:
                raise GifError("code stream without an end")
            out, length, table, last = out[: len(out) - upto], length - sum(map(len, out[len(out) - upto :])), list(roots), None
            continue
        at, table, last = int(ends[upto]), list(roots), None
    if length < size:
        raise GifError("code stream ends early")
    return b"".join(out)[:size]


def _blocks(stream: bytes) -> bytes:
    return b"".join(bytes([len(part := stream[i : i + 255])]) + part for i in range(0, len(stream), 255)) + b"\0"


def encode(gif: Gif, streams: list[bytes] | None = None) -> bytes:
    """A GIF89a file. Palettes hold 2 to 256 colours, a power of two.

    ``streams``, if given, are the frames' code streams, made before.
    """
    depth = lambda p: max(1, (len(p) - 1).bit_length())
    table = gif.palette
    out = [b"GIF89a", gif.width.to_bytes(2, "little"), gif.height.to_bytes(2, "little")]
    out.append(bytes([0 if table is None else 0xF0 | depth(table) - 1, gif.background, 0]))
    out.append(b"" if table is None else table.astype(np.uint8).tobytes())
    if gif.loops is not None:
        out.append(b"\x21\xff\x0bNETSCAPE2.0\x03\x01" + gif.loops.to_bytes(2, "little") + b"\0")
    for n, f in enumerate(gif.frames):
        out.append(b"\x21\xf9\x04" + bytes([f.disposal << 2 | (f.transparent is not None)]) + f.delay.to_bytes(2, "little") + bytes([f.transparent or 0, 0]))
        height, width = f.indices.shape
        own = table is None or f.palette is not table
        out.append(b"\x2c" + b"".join(n.to_bytes(2, "little") for n in (f.left, f.top, width, height)) + bytes([0x80 | depth(f.palette) - 1 if own else 0]))
        out.append(f.palette.astype(np.uint8).tobytes() if own else b"")
        root = max(2, depth(f.palette))
        out.append(bytes([root]) + _blocks(streams[n] if streams else lzw_encode(f.indices.astype(np.uint8).tobytes(), root)))
    return b"".join([*out, b"\x3b"])


def decode(data: bytes) -> Gif:
    """Read a GIF87a or GIF89a file; interlaced images are put in order."""
    return decode_all([parse(data)])[0]


def decode_all(files: list[Gif]) -> list[Gif]:
    """Decode the images of parsed files, those of equal size side by side."""
    alike = defaultdict(list)
    for gif in files:
        for f in gif.frames:
            alike[f.stream[1:]].append(f)
    for (root, height, width), frames in alike.items():
        for i in range(0, len(frames), STREAMS_AT_ONCE):
            part = frames[i : i + STREAMS_AT_ONCE]
            for f, image in zip(part, lzw_images([f.stream[0] for f in part], root, height * width), strict=True):
                f.indices, f.stream = np.frombuffer(image, dtype=np.uint8).reshape(height, width), None
                if f.interlaced:
                    order = np.concatenate([np.arange(a, height, s) for a, s in ((0, 8), (4, 8), (2, 4), (1, 2))])
                    f.indices = f.indices[np.argsort(order)]
    return files


def parse(data: bytes) -> Gif:
    """The structure of a GIF87a or GIF89a file, with images as code streams."""
    if data[:6] not in (b"GIF87a", b"GIF89a") or len(data) < 13:
        raise GifError("no GIF header")
    number = lambda i: int.from_bytes(data[i : i + 2], "little")

    def colours(at: int, flags: int) -> tuple[np.ndarray | None, int]:
        if not flags & 0x80:
            return None, at
        n = 2 << (flags & 7)
        if at + 3 * n > len(data):
            raise GifError("palette ends early")
        return np.frombuffer(data, dtype=np.uint8, count=3 * n, offset=at).reshape(n, 3), at + 3 * n

    def blocks(at: int) -> tuple[bytes, int]:
        parts = []
        while at < len(data) and data[at]:
            parts.append(data[at + 1 : at + 1 + data[at]])
            at += 1 + data[at]
        if at >= len(data):
            raise GifError("blocks end early")
        return b"".join(parts), at + 1

    gif = Gif(number(6), number(8), data[11])
    gif.palette, at = colours(13, data[10])
    control = b""
    while True:
        if at >= len(data):
            raise GifError("no trailer")
        kind, at = data[at], at + 1
        if kind == 0x3B:
            return gif
        if kind == 0x21:
            label = data[at] if at < len(data) else 0
            body, at = blocks(at + 1)
            if label == 0xF9 and len(body) >= 4:
                control = body
            elif label == 0xFF and body[:11] == b"NETSCAPE2.0" and len(body) >= 14:
                gif.loops = int.from_bytes(body[12:14], "little")
            continue
        if kind != 0x2C or at + 10 > len(data):
            raise GifError("unknown block")
        left, top, width, height, flags = number(at), number(at + 2), number(at + 4), number(at + 6), data[at + 8]
        palette, at = colours(at + 9, flags)
        palette = gif.palette if palette is None else palette
        root = data[at] if at < len(data) else 0
        if palette is None or not 2 <= root <= 8:
            raise GifError("image without palette or code size")
        stream, at = blocks(at + 1)
        frame = Frame(_EMPTY, palette, left, top, interlaced=bool(flags & 0x40), stream=(stream, root, height, width))
        if control:
            frame.delay, frame.disposal = int.from_bytes(control[1:3], "little"), control[0] >> 2 & 7
            frame.transparent = control[3] if control[0] & 1 else None
        gif.frames.append(frame)
        control = b""


def render(gif: Gif) -> Iterator[tuple[np.ndarray, int]]:
    """The canvas (height, width, RGBA) as each frame shows it, with the frame's delay.

    Transparent indices leave the canvas as it was. Disposal 2 clears the frame's area, and 3
    brings back what was there before it.
    """
    canvas = np.zeros((gif.height, gif.width, 4), dtype=np.uint8)
    for f in gif.frames:
        height, width = min(f.indices.shape[0], gif.height - f.top), min(f.indices.shape[1], gif.width - f.left)
        area = (slice(f.top, f.top + max(0, height)), slice(f.left, f.left + max(0, width)))
        before = canvas[area].copy()
        indices = f.indices[: max(0, height), : max(0, width)]
        colours = np.zeros((256, 3), dtype=np.uint8)
        colours[: len(f.palette)] = f.palette
        shown = np.full(indices.shape, True) if f.transparent is None else indices != f.transparent
        canvas[area][shown] = np.concatenate([colours[indices], np.full((*indices.shape, 1), 255, dtype=np.uint8)], axis=-1)[shown]
        yield canvas.copy(), f.delay
        if f.disposal == 2:
            canvas[area] = 0
        elif f.disposal == 3:
            canvas[area] = before


def histogram(canvas: np.ndarray, levels: int = LEVELS) -> np.ndarray:
    """Counts of visible pixels by colour, ``levels`` steps of each channel."""
    step = canvas[canvas[..., 3] > 0][:, :3].astype(np.int64) * levels // 256
    return np.bincount((step[:, 0] * levels + step[:, 1]) * levels + step[:, 2], minlength=levels**3)


def payload_gifs(payloads: list[bytes]) -> list[bytes]:
    """Payloads of whole units as GIFs: one frame of 24 x 24 samples for each unit."""
    out, images, counts = [], [], []
    for n, payload in enumerate(payloads):
        images += [payload[i : i + UNIT] for i in range(0, len(payload), UNIT)]
        counts.append(len(payload) // UNIT)
        if len(images) >= STREAMS_AT_ONCE or n == len(payloads) - 1:
            streams, at = lzw_streams(images), 0
            for count in counts:
                frames = [Frame(np.frombuffer(i, dtype=np.uint8).reshape(SIDE, SIDE), PALETTE, delay=DELAY) for i in images[at : at + count]]
                out.append(encode(Gif(SIDE, SIDE, palette=PALETTE, loops=0, frames=frames), streams[at : at + count]))
                at += count
            images, counts = [], []
    return out


def padded(text: str | None) -> tuple[bytes, int]:
    """A text's bytes, filled up to a positive multiple of the unit, and their number."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    return raw + bytes([PAD]) * (-len(raw) % UNIT if raw else UNIT), len(raw)


def media(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, n_bytes, media``: every whole text stored as a GIF.

    Null and empty texts are one frame of filling. Repeated rows are stored as often as they
    come, an empty table gives no rows, and other columns are not looked at.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [padded(t) for t in batch["text"]]
            yield pd.DataFrame({"id": batch["id"], "n_bytes": [n for _, n in found], "media": payload_gifs([p for p, _ in found])})

    kind = docs.schema[id_col].dataType.simpleString()
    return text_batches(docs, id_col, text_col).mapInPandas(run, f"id {kind}, n_bytes long, media binary").withColumnRenamed("id", id_col)


def frames(stored: DataFrame, *, id_col: str = "doc_id", media_col: str = "media") -> DataFrame:
    """Timed frames of stored GIFs: ``id_col, frame, start_cs, delay_cs, width, height, pixels, histogram``.

    ``pixels`` are the canvas's RGBA bytes; times are hundredths of a second. A null or
    malformed GIF gives one row in which all but the id is null.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for key, data in zip(batch["id"], batch["media"], strict=True):
                try:
                    gif, start = decode(data or b""), 0
                except GifError:
                    rows.append((key, None, None, None, None, None, None, None))
                    continue
                for n, (canvas, delay) in enumerate(render(gif)):
                    rows.append((key, n, start, delay, gif.width, gif.height, canvas.tobytes(), histogram(canvas).tolist()))
                    start += delay
                    if len(rows) == FRAMES_A_BATCH:
                        yield pd.DataFrame(rows, columns=columns, dtype=object)
                        rows = []
            yield pd.DataFrame(rows, columns=columns, dtype=object)

    columns = ["id", "frame", "start_cs", "delay_cs", "width", "height", "pixels", "histogram"]
    kind = stored.schema[id_col].dataType.simpleString()
    schema = f"id {kind}, frame int, start_cs long, delay_cs long, width int, height int, pixels binary, histogram array<long>"
    return stored.select(F.col(id_col).alias("id"), F.col(media_col).alias("media")).mapInPandas(run, schema).withColumnRenamed("id", id_col)


def _sound(media: pd.Series) -> Iterator[Gif | None]:
    """Decoded GIFs, a few MB at a time; None for what is null or malformed."""
    group, size = [], 0
    for n, data in enumerate(media):
        group.append(data)
        size += len(data or b"")
        if size < BYTES_AT_ONCE and n < len(media) - 1:
            continue
        try:
            yield from decode_all([parse(d) for d in group])
        except (GifError, TypeError):
            for d in group:
                try:
                    yield decode(d or b"")
                except GifError:
                    yield None
        group, size = [], 0


def digests(stored: DataFrame, *, id_col: str = "doc_id") -> DataFrame:
    """What the stored bytes hold, read back: payload and media digests and the feature.

    The payload is what the frames' indices are. ``feature`` is the colour histogram of all
    shown frames as comma-separated counts; a frame that fills the canvas and hides nothing
    shows its own colours, so those are counted by index, and other frames are rendered.
    Null or malformed media give a row in which all but the id and ``n_bytes`` is null.
    """

    def feature(gif: Gif) -> np.ndarray:
        full = all(f.transparent is None and f.indices.shape == (gif.height, gif.width) and f.palette is gif.palette for f in gif.frames)
        if not full:
            return sum(histogram(c) for c, _ in render(gif))
        counts = np.bincount(np.concatenate([f.indices.ravel() for f in gif.frames]), minlength=256)
        step = gif.palette.astype(np.int64) * LEVELS // 256
        return np.bincount((step[:, 0] * LEVELS + step[:, 1]) * LEVELS + step[:, 2], weights=counts, minlength=LEVELS**3).astype(np.int64)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for key, n, data, gif in zip(batch["id"], batch["n_bytes"], batch["media"], _sound(batch["media"]), strict=True):
                if gif is None:
                    rows.append((key, n, *[None] * 6))
                    continue
                payload = b"".join(f.indices.tobytes() for f in gif.frames)
                rows.append((key, n, len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]), len(data), hashlib.sha256(data).hexdigest(), ",".join(map(str, feature(gif)))))
            yield pd.DataFrame(rows, columns=["id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"], dtype=object)

    kind = stored.schema[id_col].dataType.simpleString()
    schema = f"id {kind}, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"
    return stored.select(F.col(id_col).alias("id"), "n_bytes", "media").mapInPandas(run, schema).withColumnRenamed("id", id_col)
