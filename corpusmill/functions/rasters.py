"""Raster work in numpy, for Arrow functions: formats, stretches, resizing, connected regions."""

from __future__ import annotations

import io
import math
import struct
import zlib

import numpy as np

PNG_HEAD = b"\x89PNG\r\n\x1a\n"


def read_npy(data: bytes) -> np.ndarray:
    return np.load(io.BytesIO(data), allow_pickle=False)


def _lzw(data: bytes) -> bytes:
    """Bytes of a TIFF's LZW stream: codes of 9 to 12 bits, highest bit first."""
    out, table, width, last = bytearray(), [], 9, b""
    held = bits = 0
    for byte in data:
        held, bits = held << 8 | byte, bits + 8
        if bits < width:
            continue
        bits -= width
        code, held = held >> bits, held & ((1 << bits) - 1)
        if code == 257:
            break
        if code == 256:
            table, width, last = [bytes([k]) for k in range(256)] + [b"", b""], 9, b""
            continue
        entry = table[code] if code < len(table) else last + last[:1]
        out += entry
        if last:
            table.append(last + entry[:1])
        last = entry
        # the writer changes width one code early
        width = 12 if len(table) >= 2047 else 11 if len(table) >= 1023 else 10 if len(table) >= 511 else 9
    return bytes(out)


def _packbits(data: bytes) -> bytes:
    out, at = bytearray(), 0
    while at < len(data):
        n = data[at]
        if n < 128:
            out += data[at + 1 : at + 2 + n]
            at += 2 + n
        else:
            out += data[at + 1 : at + 2] * (257 - n if n > 128 else 0)
            at += 2
    return bytes(out)


#: Compressions by their number.
UNPACK = {1: bytes, 5: _lzw, 8: zlib.decompress, 32773: _packbits, 32946: zlib.decompress}


def read_tiff(data: bytes) -> np.ndarray:
    """First image of a TIFF in strips or tiles: no, LZW, deflate or packbits compression, predictor 1 or 2, chunky or planar; (H, W) or (H, W, C)."""
    end = {b"II": "<", b"MM": ">"}[data[:2]]
    (at,) = struct.unpack_from(end + "I", data, 4)
    (count,) = struct.unpack_from(end + "H", data, at)
    tags: dict[int, tuple] = {}
    sizes = {1: ("B", 1), 3: ("H", 2), 4: ("I", 4)}
    for k in range(count):
        tag, kind, n = struct.unpack_from(end + "HHI", data, at + 2 + 12 * k)
        if kind in sizes:
            code, size = sizes[kind]
            where = at + 10 + 12 * k
            if n * size > 4:
                (where,) = struct.unpack_from(end + "I", data, where)
            tags[tag] = struct.unpack_from(f"{end}{n}{code}", data, where)
    one = lambda t, default: tags.get(t, (default,))[0]
    width, height, bands = one(256, 0), one(257, 0), one(277, 1)
    kind = {1: "u", 2: "i", 3: "f"}[one(339, 1)]
    dtype = np.dtype(f"{end}{kind}{one(258, 8) // 8}")
    if one(259, 1) not in UNPACK or one(317, 1) not in (1, 2):
        raise ValueError("this TIFF's compression is not read")
    unpack, planar = UNPACK[one(259, 1)], one(284, 1) == 2
    across = 1 if planar else bands
    # strips are tiles of the whole width
    tiled = 322 in tags
    wide, high = (one(322, width), one(323, height)) if tiled else (width, min(one(278, height), height))
    starts, lengths = (tags[324], tags[325]) if tiled else (tags[273], tags[279])
    columns, rows = math.ceil(width / wide), math.ceil(height / high)
    full = np.zeros((height, width, bands), dtype.newbyteorder("="))
    for k, (lo, n) in enumerate(zip(starts, lengths, strict=True)):
        plane, at = divmod(k, columns * rows)
        top, left = at // columns * high, at % columns * wide
        lines = high if tiled else min(high, height - top)
        part = np.frombuffer(unpack(data[lo : lo + n]), dtype, lines * wide * across).reshape(lines, wide, across)
        if one(317, 1) == 2:
            part = np.cumsum(part, axis=1, dtype=full.dtype)
        y, x = min(high, height - top), min(wide, width - left)
        full[top : top + y, left : left + x, plane if planar else slice(None)] = part[:y, :x, 0] if planar else part[:y, :x]
    return full[:, :, 0] if full.shape[2] == 1 else full


def write_png(image: np.ndarray, level: int = 6) -> bytes:
    """RGB PNG of (H, W), (H, W, 1) or (H, W, 3); values are cut to 8 bits."""
    image = np.asarray(image)
    if image.ndim == 2:
        image = image[:, :, None]
    if image.shape[2] == 1:
        image = np.repeat(image, 3, axis=2)
    if image.shape[2] != 3:
        raise ValueError(f"1 or 3 channels are needed, not {image.shape[2]}")
    image = image.astype(np.uint8)
    rows = np.concatenate([np.zeros((image.shape[0], 1), np.uint8), image.reshape(image.shape[0], -1)], axis=1)
    part = lambda name, body: struct.pack(">I", len(body)) + name + body + struct.pack(">I", zlib.crc32(name + body))
    head = struct.pack(">IIBBBBB", image.shape[1], image.shape[0], 8, 2, 0, 0, 0)
    return PNG_HEAD + part(b"IHDR", head) + part(b"IDAT", zlib.compress(rows.tobytes(), level)) + part(b"IEND", b"")


def _unfiltered(raw: bytes, height: int, line: int, step: int) -> np.ndarray:
    """Rows of a PNG without their filters; step: bytes of a pixel."""
    rows = np.frombuffer(raw, np.uint8, height * (line + 1)).reshape(height, line + 1)
    out = np.zeros((height, line), np.uint8)
    above = np.zeros(line, np.uint8)
    for y in range(height):
        kind, own = rows[y, 0], rows[y, 1:]
        if kind == 1:  # each byte minus the one a pixel before
            pad = -line % step
            own = np.cumsum(np.pad(own, (0, pad)).reshape(-1, step), axis=0, dtype=np.uint8).ravel()[:line]
        elif kind == 2:
            own = own + above
        elif kind:
            # these depend on the byte just made, so they go byte by byte, in plain integers
            done, up = bytearray(own.tobytes()), above.tobytes()
            if kind == 3:
                for x in range(line):
                    done[x] = (done[x] + ((done[x - step] if x >= step else 0) + up[x]) // 2) & 255
            else:
                for x in range(min(step, line)):
                    done[x] = (done[x] + up[x]) & 255
                for x in range(step, line):
                    left, top, corner = done[x - step], up[x], up[x - step]
                    p, q = top - corner, left - corner
                    r = p + q
                    p, q, r = (p if p >= 0 else -p), (q if q >= 0 else -q), (r if r >= 0 else -r)
                    done[x] = (done[x] + (left if p <= q and p <= r else top if q <= r else corner)) & 255
            own = np.frombuffer(bytes(done), np.uint8)
        out[y] = above = own
    return out


def read_png(data: bytes) -> np.ndarray:
    """A PNG without interlacing as (H, W) or (H, W, C): gray, RGB, with or without alpha, of 8 or 16 bits, or a palette (as RGB)."""
    if data[:8] != PNG_HEAD:
        raise ValueError("not a PNG")
    at, body, head, palette = 8, [], b"", b""
    while at < len(data):
        size, name = struct.unpack_from(">I4s", data, at)
        part = data[at + 8 : at + 8 + size]
        if name == b"IHDR":
            head = part
        elif name == b"PLTE":
            palette = part
        elif name == b"IDAT":
            body.append(part)
        at += 12 + size
    width, height, depth, kind, _, _, laced = struct.unpack(">IIBBBBB", head)
    bands = {0: 1, 2: 3, 3: 1, 4: 2, 6: 4}[kind]
    if laced:
        raise ValueError("PNGs with interlacing are not read")
    line = (width * bands * depth + 7) // 8
    rows = _unfiltered(zlib.decompress(b"".join(body)), height, line, max(1, bands * depth // 8))
    if depth == 16:
        image = rows.view(">u2").astype(np.uint16)
    elif depth == 8:
        image = rows
    else:  # several pixels in a byte; gray is spread over 8 bits
        bits = np.unpackbits(rows, axis=1).reshape(height, -1, depth)
        image = (bits @ (1 << np.arange(depth)[::-1])).astype(np.uint8)[:, :width]
        image = image if kind == 3 else (image * (255 // (2**depth - 1))).astype(np.uint8)
    if kind == 3:
        return np.frombuffer(palette, np.uint8).reshape(-1, 3)[image]
    image = image.reshape(height, width, bands)
    return image[:, :, 0] if bands == 1 else image


def kernel(name: str, x: np.ndarray) -> np.ndarray:
    """Resampling kernels: box, triangle, and cubic with a = -1/2."""
    x = np.abs(x)
    if name == "box":
        return (x <= 0.5).astype(float)
    if name == "bilinear":
        return np.maximum(0, 1 - x)
    return np.where(x < 1, (1.5 * x - 2.5) * x * x + 1, np.where(x < 2, ((-0.5 * x + 2.5) * x - 4) * x + 2, 0))


def weights(old: int, new: int, name: str) -> np.ndarray:
    """new x old matrix of area-aware resampling weights."""
    scale = old / new
    wide = max(scale, 1.0)
    centre = (np.arange(new) + 0.5) * scale
    if name == "box" and scale >= 1:  # exact areas
        lo = np.maximum(np.arange(old)[None, :], (centre - scale / 2)[:, None])
        hi = np.minimum(np.arange(old)[None, :] + 1, (centre + scale / 2)[:, None])
        w = np.maximum(hi - lo, 0)
    else:
        w = kernel(name, (np.arange(old)[None, :] + 0.5 - centre[:, None]) / wide)
    return w / w.sum(axis=1, keepdims=True)


def resize(image: np.ndarray, height: int, width: int, name: str = "bicubic") -> np.ndarray:
    """Separable resampling; whole-number images are rounded and clamped to their type."""
    out = np.einsum("yh,hwc->ywc", weights(image.shape[0], height, name), image.reshape(image.shape[0], image.shape[1], -1).astype(float))
    out = np.einsum("xw,ywc->yxc", weights(image.shape[1], width, name), out)
    if np.issubdtype(image.dtype, np.integer):
        bounds = np.iinfo(image.dtype)
        out = np.clip(np.floor(out + 0.5), bounds.min, bounds.max)
    return out.astype(image.dtype).reshape(height, width, *image.shape[2:])


def proxy_image(image: np.ndarray, factor: int = 4, least: int = 32) -> np.ndarray:
    return resize(image, max(least, image.shape[0] // factor), max(least, image.shape[1] // factor), "bicubic")


def downsample(image: np.ndarray, target: float, native: float) -> np.ndarray:
    """Area averages from the native to a coarser target resolution; the image itself if it is as coarse already."""
    if native >= target:
        return image
    side = lambda n: max(1, round(n * (native / target)))
    return resize(image, side(image.shape[0]), side(image.shape[1]), "box")


def stretch(values: np.ndarray, top: float) -> np.ndarray:
    """Values 0..top as bytes, towards zero."""
    return (np.clip(values, 0, top).astype(np.float32) / np.float32(top) * np.float32(255)).astype(np.uint8)


def multispectral_rgb(image: np.ndarray, bands: tuple[int, ...] = (3, 2, 1)) -> np.ndarray:
    """RGB of a (bands, H, W) image, stretched to the 98th percentile of all three bands together."""
    rgb = np.moveaxis(image[list(bands)], 0, -1).astype(np.float32)
    top = np.percentile(rgb, 98)
    return stretch(rgb, top) if top > 0 else rgb.astype(np.uint8)


def reflectance_rgb(rgb: np.ndarray) -> np.ndarray:
    """16-bit reflectances against 10000; other types above 255 against their 98th percentile; else unchanged."""
    if rgb.dtype == np.uint16:
        return stretch(rgb, 10000)
    return stretch(rgb, np.percentile(rgb, 98)) if rgb.max() > 255 else rgb


def tile_rgb(image: np.ndarray) -> np.ndarray:
    """The first three channels (gray is replicated), 16 bits stretched to the 98th percentile."""
    image = np.stack([image] * 3, axis=-1) if image.ndim == 2 else image[:, :, :3]
    if image.dtype != np.uint16:
        return image
    top = np.percentile(image, 98)
    return stretch(image, top) if top > 0 else image.astype(np.uint8)


def binary_mask(mask: np.ndarray, shape: tuple[int, int] | None = None) -> np.ndarray:
    """First plane, 1 where over zero, resized to the nearest pixel."""
    mask = (mask[:, :, 0] if mask.ndim == 3 else mask) > 0
    if shape and mask.shape != shape:
        y, x = (np.minimum(((np.arange(n) + 0.5) * m / n).astype(int), m - 1) for n, m in zip(shape, mask.shape, strict=True))
        mask = mask[np.ix_(y, x)]
    return mask.astype(np.uint8)


def side_by_side(left: np.ndarray, right: np.ndarray, height: int | None = None, gap: int = 2, gray: int = 128) -> np.ndarray:
    """Two RGB images beside each other with a gray gap; both at the given height, or the right at the left's."""
    for image in (left, right):
        if image.ndim != 3 or image.shape[2] != 3:
            raise ValueError("two images of 3 channels are needed")
    high = height or left.shape[0]
    fit = lambda im: im if im.shape[0] == high and height is None else resize(im, high, max(1, int(im.shape[1] * (high / im.shape[0]))), "bilinear")
    left, right = fit(left), fit(right)
    return np.concatenate([left, np.full((high, gap, 3), gray, np.uint8), right], axis=1)


def concat_png(left: bytes, right: bytes, **options) -> bytes:
    """Two PNGs beside each other, as an uncompressed PNG."""
    colour = lambda x: np.stack([x] * 3, axis=-1) if x.ndim == 2 else x[:, :, :3]
    return write_png(side_by_side(colour(read_png(left)), colour(read_png(right)), **options), 0)


def class_boxes(mask: np.ndarray, classes: int) -> list[list[float]]:
    """For each class in a mask of class numbers the box around its pixels, on the grid of 1000."""
    mask = mask[:, :, 0] if mask.ndim == 3 else mask
    h, w = mask.shape
    out = []
    for k in range(classes):
        ys, xs = np.nonzero(mask == k)
        if len(ys):
            out.append([round(float(v) / n * 1000, 2) for v, n in ((xs.min(), w), (ys.min(), h), (xs.max(), w), (ys.max(), h))])
    return out


def db(values: np.ndarray, low: float, high: float) -> np.ndarray:
    return np.clip(10 * np.log10(np.maximum(values, 1e-10)), low, high)


def to_byte(values: np.ndarray, low: float, high: float) -> np.ndarray:
    return (np.clip((values - low) / (high - low), 0, 1) * 255).astype(np.uint8)


def radar_rgb(vv: np.ndarray, vh: np.ndarray | None = None, hh: np.ndarray | None = None) -> np.ndarray:
    """False colour of radar intensities: one plane in gray, two as (VV, VH, difference), three as (HH, VV, VH)."""
    a = db(vv, -25, 0)
    if vh is None:
        return np.stack([to_byte(a, -25, 0)] * 3, axis=-1)
    b = db(vh, -30, -5)
    if hh is None:
        return np.stack([to_byte(a, -25, 0), to_byte(b, -30, -5), to_byte(a - b, 0, 25)], axis=-1)
    return np.stack([to_byte(db(hh, -25, 0), -25, 0), to_byte(a, -25, 0), to_byte(b, -30, -5)], axis=-1)
