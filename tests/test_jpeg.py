"""JPEGs written and read by the Java runtime's own codec, which shares no code with ours."""

import struct
import zlib

import numpy as np
import pytest

from millrace.functions.images import decode_image, phash, unique_colors
from millrace.functions.jpeg import decode_jpeg, grey_jpeg


def png(pixels: np.ndarray) -> bytes:
    raw = b"".join(b"\0" + row.tobytes() for row in pixels)
    chunk = lambda name, body: struct.pack(">I", len(body)) + name + body + struct.pack(">I", zlib.crc32(name + body))
    head = struct.pack(">IIBBBBB", pixels.shape[1], pixels.shape[0], 8, 2, 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b"")


def picture(height: int, width: int) -> np.ndarray:
    y, x = np.mgrid[:height, :width]
    return np.stack([(x * 5 + y) % 256, 128 + 100 * np.sin(x / 9) * np.cos(y / 7), (y * 3) % 256], 2).clip(0, 255).astype(np.uint8)


class Java:
    def __init__(self, spark):
        self.jvm = spark._jvm
        self.jvm.java.lang.System.setProperty("java.awt.headless", "true")
        self.io = self.jvm.javax.imageio.ImageIO

    def image(self, data: bytes):
        return self.io.read(self.jvm.java.io.ByteArrayInputStream(data))

    def jpeg(self, pixels: np.ndarray, quality: float, progressive: bool) -> bytes:
        writer = self.io.getImageWritersByFormatName("jpeg").next()
        param = writer.getDefaultWriteParam()
        param.setCompressionMode(2)
        param.setCompressionQuality(quality)
        param.setProgressiveMode(1 if progressive else 0)
        out = self.jvm.java.io.ByteArrayOutputStream()
        writer.setOutput(self.io.createImageOutputStream(out))
        writer.write(None, self.jvm.javax.imageio.IIOImage(self.image(png(pixels)), None, None), param)
        writer.getOutput().flush()
        return bytes(out.toByteArray())

    def pixels(self, data: bytes) -> np.ndarray:
        out = self.jvm.java.io.ByteArrayOutputStream()
        self.io.write(self.image(data), "png", out)
        return decode_image(bytes(out.toByteArray()))


@pytest.mark.parametrize("progressive", [False, True])
@pytest.mark.parametrize("height, width, quality", [(64, 64, 0.9), (37, 91, 0.75), (8, 8, 0.5), (150, 17, 0.97), (1, 1, 0.9)])
def test_like_java(spark, progressive, height, width, quality):
    java = Java(spark)
    data = java.jpeg(picture(height, width), quality, progressive)
    assert (b"\xff\xc2" in data) == progressive
    got, want = decode_jpeg(data), java.pixels(data)
    assert got.shape == want.shape == (height, width, 3)
    difference = np.abs(got.astype(int) - want)
    assert difference.max() <= 6 and difference.mean() < 0.8
    assert bin(int(phash(got), 16) ^ int(phash(want), 16)).count("1") <= 2 or height < 32


def test_grey_restarts_and_bad_data(spark):
    data = Java(spark).jpeg(picture(64, 64), 0.9, False)
    assert unique_colors(decode_image(data)) > 32
    early = decode_image(data[: len(data) * 4 // 5])
    assert early.shape == (64, 64, 3) and (early[:8] == decode_image(data)[:8]).all()
    values = [(i * 37) % 256 for i in range(64)]
    for restart in (0, 1, 5, 64):
        flat = decode_image(grey_jpeg(values, restart))
        assert flat.shape == (64, 64, 3) and flat[::8, ::8, 0].ravel().tolist() == values
    for bad in (b"", b"\xff\xd8", b"\xff\xd8\xff\xd9", data[:30], b"\xff\xd8" + bytes(100), data[:300].replace(b"\xff\xc0", b"\xff\xc9")):
        assert decode_image(bad) is None
