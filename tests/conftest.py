from __future__ import annotations

import os
import struct
import sys
import tempfile
import zlib

import numpy as np
import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from specimen.session import get_session
    s = get_session("specimen-tests", cores=4, shuffle_partitions=8)
    yield s


def png_bytes(rgb: np.ndarray) -> bytes:
    """Minimal PNG encoder (8-bit RGB, RGB + alpha or grey), no external library."""
    rgb = np.ascontiguousarray(rgb, dtype=np.uint8)
    if rgb.ndim == 2:
        rgb = rgb[:, :, None]
    h, w, c = rgb.shape
    colour = {1: 0, 3: 2, 4: 6}[c]
    raw = b"".join(b"\x00" + rgb[y].tobytes() for y in range(h))

    def chunk(tag, data):
        return (struct.pack(">I", len(data)) + tag + data +
                struct.pack(">I", zlib.crc32(tag + data) & 0xFFFFFFFF))

    ihdr = struct.pack(">IIBBBBB", w, h, 8, colour, 0, 0, 0)
    return (b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", ihdr) + chunk(b"IDAT", zlib.compress(raw))
            + chunk(b"IEND", b""))


def png_decoder(data: bytes):
    """Test-only decoder for the PNGs ``png_bytes`` writes (8-bit, filter 0),
    standing in for Pillow: returns BGR, raises on anything else."""
    if not data.startswith(b"\x89PNG\r\n\x1a\n"):
        raise ValueError("not a PNG")
    pos, idat = 8, b""
    w = h = c = None
    while pos < len(data):
        (n,) = struct.unpack(">I", data[pos:pos + 4])
        tag, body = data[pos + 4:pos + 8], data[pos + 8:pos + 8 + n]
        if tag == b"IHDR":
            w, h, _, colour = struct.unpack(">IIBB", body[:10])
            c = {0: 1, 2: 3, 6: 4}[colour]
        elif tag == b"IDAT":
            idat += body
        pos += 12 + n
    raw = np.frombuffer(zlib.decompress(idat), np.uint8).reshape(h, 1 + w * c)
    img = raw[:, 1:].reshape(h, w, c)
    order = {1: [0], 3: [2, 1, 0], 4: [2, 1, 0, 3]}[c]
    return np.ascontiguousarray(img[:, :, order])


@pytest.fixture(scope="session")
def image_root():
    """A data root with two part folders and the edge cases of SURVEY §5."""
    from specimen.sources.carriers import _synth_pixels
    root = tempfile.mkdtemp(prefix="specimen-img-")
    p1, p2 = os.path.join(root, "part_1"), os.path.join(root, "part_2")
    os.makedirs(p1)
    os.makedirs(p2)
    files = {
        os.path.join(p1, "IMG_1.jpg"): png_bytes(_synth_pixels(1)),
        os.path.join(p1, "IMG_2.JPG"): png_bytes(_synth_pixels(2)),
        os.path.join(p2, "IMG_2.jpg"): png_bytes(_synth_pixels(22)),   # part 1 copy wins
        os.path.join(p2, "IMG_3.jpeg"): png_bytes(_synth_pixels(3)),
        os.path.join(p2, "IMG_4.jpg"): b"this is not an image at all" * 10,  # junk
        os.path.join(p1, "IMG_5.jpg"): b"",                               # zero bytes
        os.path.join(p1, "IMG_6.jpg"): png_bytes(np.full((1, 1, 3), 90, np.uint8)),
        os.path.join(p2, "IMG_7.jpg"): png_bytes(np.full((40, 30, 3), 200, np.uint8)),
        os.path.join(p1, "IMG_8.jpg"): png_bytes(
            np.random.RandomState(8).randint(0, 256, (450, 600, 3)).astype(np.uint8)),
        os.path.join(p1, "_IMG_10.jpg"): png_bytes(_synth_pixels(10)),    # hidden to Spark's sources
        os.path.join(p2, "IMG_11.jPg"): png_bytes(_synth_pixels(11)),
        os.path.join(p1, "IMG_12.jpg"): png_bytes(_synth_pixels(12)[:, :, 0]),        # grey
        os.path.join(p2, "IMG_13.jpg"): png_bytes(np.dstack([_synth_pixels(13), np.full((64, 64), 90, np.uint8)])),
        os.path.join(p1, "notes.txt"): b"not an image",
    }
    for path, data in files.items():
        with open(path, "wb") as f:
            f.write(data)
    meta = os.path.join(root, "metadata.csv")
    with open(meta, "w") as f:
        f.write("lesion_id,image_id,dx,dx_type,sex,age,localization\n")
        f.write("L1,IMG_1,nv,histo,male,45.0,back\n")
        f.write("L2,IMG_2,mel,histo,female,50.0,face\n")
        f.write("L3,IMG_3,nv,consensus,male,,back\n")       # null age -> quarantined
        f.write("L4,IMG_4,bkl,histo,male,60.0,trunk\n")      # junk image
        f.write("L5,IMG_5,nv,histo,female,30.0,back\n")      # zero-byte file: FAILED
        f.write("L6,IMG_6,nv,histo,male,35.0,back\n")        # 1x1
        f.write("L7,IMG_7,bcc,histo,male,70.0,face\n")       # one colour
        f.write("L8,IMG_8,nv,histo,female,40.0,scalp\n")     # 600x450 noise
        f.write("L9,IMG_9,nv,histo,female,41.0,scalp\n")     # no file
        f.write("L10,,nv,histo,female,42.0,scalp\n")         # null id
        f.write("L11,IMG_1,nv,histo,male,,back\n")           # repeated id, null age
        f.write("L12,IMG_12,mel,histo,male,52.0,back\n")     # grey file
        f.write("L13,IMG_13,mel,histo,male,53.0,back\n")     # file with alpha
    return root
