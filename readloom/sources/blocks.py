"""Block gzip: gzip files of many small members, each of which says how long it is.

Such a file reads as any gzip file, but a reader can start at every member. A
member's header has an extra field ``BC`` with its size; it holds 64 KB of text at
most. A member that starts in a byte range is found without an index: the first
place in the range with a header, whose member unpacks to the text its checksum says, and that
is followed by another header (or by the end of the file) where it says.
"""

from __future__ import annotations

import io
import struct
import zlib
from collections.abc import Iterator

from readloom.functions.shipping import ship

ship(__name__)

# The start of a member, the name of the extra field, the most text in a member, the empty last member.
MAGIC = b"\x1f\x8b\x08\x04"
FIELD = b"BC"
MOST = 65280
LAST = bytes.fromhex("1f8b08040000000000ff0600424302001b0003000000000000000000")
FIXED = 12


def member_size(head: bytes) -> int:
    """Bytes of the member that starts with these bytes; 0 when it is none of this kind."""
    if len(head) < FIXED or not head.startswith(MAGIC):
        return 0
    extra = head[FIXED:FIXED + struct.unpack_from("<H", head, 10)[0]]
    at = 0
    while at + 4 <= len(extra):
        size = struct.unpack_from("<H", extra, at + 2)[0]
        if extra[at:at + 2] == FIELD and size == 2 and at + 6 <= len(extra):
            return struct.unpack_from("<H", extra, at + 4)[0] + 1
        at += 4 + size
    return 0


def head_at(handle, at: int) -> bytes:
    handle.seek(at)
    return handle.read(FIXED + 256)


def is_blocked(handle) -> bool:
    """Whether a file begins with a member of this kind."""
    return member_size(head_at(handle, 0)) > 0


def is_whole(handle, at: int, size: int) -> bool:
    """Whether the bytes are one packed text with its checksum."""
    handle.seek(at)
    try:
        zlib.decompress(handle.read(size), 31)
    except zlib.error:
        return False
    return True


def first_member(handle, start: int, stop: int, size: int) -> int | None:
    """Where the first member in ``[start, stop)`` begins; ``size`` is that of the file."""
    at = start
    while at < min(stop, size):
        handle.seek(at)
        window = handle.read(min(1 << 17, stop - at + FIXED + 256))
        found = window.find(MAGIC)
        while found >= 0 and at + found < stop:
            n = member_size(head_at(handle, at + found))
            following = at + found + n
            if n and (following == size or following < size and member_size(head_at(handle, following))) and is_whole(handle, at + found, n):
                return at + found
            found = window.find(MAGIC, found + 1)
        if at + len(window) >= min(stop, size):
            return None
        at += len(window) - len(MAGIC) + 1
    return None


def members(handle, at: int) -> Iterator[tuple[int, bytes]]:
    """``(start, text)`` of every member from the one at ``at`` to the end of the file."""
    handle.seek(at)
    while head := handle.read(FIXED):
        extra = handle.read(struct.unpack_from("<H", head, 10)[0]) if len(head) == FIXED and head.startswith(MAGIC) else b""
        size = member_size(head + extra)
        if not size:
            raise ValueError(f"no block gzip member at byte {at}; read the file whole (split_bytes=0)")
        body = handle.read(size - FIXED - len(extra))
        yield at, zlib.decompress(head + extra + body, 31)
        at += size


class MemberStream(io.RawIOBase):
    """The text of a file from one member on; it runs forward only."""

    def __init__(self, handle, at: int):
        self.handle = handle
        self.texts = (text for _, text in members(handle, at))
        self.left = memoryview(b"")
        self.at = 0

    def readable(self) -> bool:
        return True

    def seekable(self) -> bool:
        return True

    def tell(self) -> int:
        return self.at

    def seek(self, at: int, whence: int = 0) -> int:
        if whence != 0 or at != self.at:
            raise io.UnsupportedOperation("the text of members runs forward only")
        return at

    def readinto(self, into) -> int:
        while not self.left:
            text = next(self.texts, None)
            if text is None:
                return 0
            self.left = memoryview(text)
        n = min(len(into), len(self.left))
        into[:n], self.left = self.left[:n], self.left[n:]
        self.at += n
        return n

    def close(self) -> None:
        self.handle.close()
        super().close()


def member_of(text: bytes, level: int = 6) -> bytes:
    """A member of at most ``MOST`` bytes of text."""
    packer = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = packer.compress(text) + packer.flush()
    head = MAGIC + b"\0\0\0\0\0\xff" + struct.pack("<H2sHH", 6, FIELD, 2, len(body) + 25)
    return head + body + struct.pack("<II", zlib.crc32(text), len(text))
