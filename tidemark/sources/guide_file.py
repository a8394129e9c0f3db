"""A sink for one compressed guide: channels, then programmes, under one root.

Tasks write compressed members, one for each (kind, id, part) of their sorted rows, into files of their own; a file that
several members make, one after the other, is again a compressed file. The commit lays the members of the tasks that
succeeded out in the order of their keys, after the root's opening and before its end, and then moves the file into place, so
a failed run leaves the old guide as it was, and an attempt that isn't committed leaves nothing in it. Members don't depend on
which task wrote them: equal rows give equal bytes. Each member starts with HEADER, whose extra field no other writer has, so a
reader can tell where members start without inflating what is before, and deal them out (see xmltv.read_elements).

Rows come grouped by their key within a task (see xmltv.write_guide).
"""

from __future__ import annotations

NAME = "tidemark_guide"
#: A gzip header with an extra field: deflate, no time, its subfield TM with twelve bytes drawn once.
HEADER = bytes.fromhex("1f8b0804000000000203" "1000" "544d0c00" "9ae1c35d0f7b48b2d6641fe8")
SCHEMA = "kind int, id string, part string, at string, xml string"


def guide_format() -> type:
    """The data source. Its classes are made here, so that they travel to the workers with the query."""
    from dataclasses import dataclass

    from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

    opening, ending = b'<?xml version="1.0" encoding="utf-8"?>\n<tv>\n', b"</tv>\n"
    name, schema, header = NAME, SCHEMA, HEADER
    piece, open_files = 4 << 20, 256

    def compressed(texts):
        import struct
        import zlib

        member, crc, size = zlib.compressobj(9, zlib.DEFLATED, -15), 0, 0
        yield header
        for text in texts:
            crc, size = zlib.crc32(text, crc), size + len(text)
            yield member.compress(text)
        yield member.flush() + struct.pack("<II", crc, size & 0xFFFFFFFF)

    @dataclass
    class Members(WriterCommitMessage):
        file: str
        #: (kind, id, part), offset, length
        found: list

    class Guide(DataSourceArrowWriter):
        def __init__(self, path: str):
            self.path = path

        def _store(self):
            from pyarrow import fs

            return fs.FileSystem.from_uri(self.path) if "://" in self.path or self.path.startswith("file:") else (fs.LocalFileSystem(), self.path)

        def write(self, batches):
            import uuid
            from itertools import groupby

            store, path = self._store()
            folder = f"{path}.members"
            store.create_dir(folder)
            out = Members(f"{folder}/{uuid.uuid4().hex}", [])
            rows = (r for b in batches for r in zip(*(b.column(c).to_pylist() for c in ("kind", "id", "part", "xml")), strict=True))
            with store.open_output_stream(out.file) as f:
                at = 0
                for key, group in groupby(rows, key=lambda r: (r[0], r[1] or "", r[2] or "")):
                    size = sum(f.write(x) for x in compressed(f"{r[3]}\n".encode() for r in group))
                    out.found.append((key, at, size))
                    at += size
            return out

        def commit(self, messages):
            store, path = self._store()
            done = [m for m in messages if m is not None]
            members = sorted((*x, m.file) for m in done for x in m.found)
            with store.open_output_stream(f"{path}.new") as f:
                for x in compressed([opening]):
                    f.write(x)
                held = {}
                for _, at, size, file in members:
                    if file not in held:
                        if len(held) == open_files:
                            held.pop(next(iter(held))).close()
                        held[file] = store.open_input_file(file)
                    for a in range(at, at + size, piece):
                        f.write(held[file].read_at(min(piece, at + size - a), a))
                for x in held.values():
                    x.close()
                for x in compressed([ending]):
                    f.write(x)
            store.move(f"{path}.new", path)
            self._forget(store, done)

        def abort(self, messages):
            self._forget(self._store()[0], [m for m in messages if m is not None])

        def _forget(self, store, messages):
            for m in messages:
                store.delete_file(m.file)

    class GuideFile(DataSource):
        @classmethod
        def name(cls):
            return name

        def schema(self):
            return schema

        def writer(self, schema, overwrite):
            return Guide(self.options["path"])

    return GuideFile
