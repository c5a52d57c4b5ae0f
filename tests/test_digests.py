"""Digests of files: of any length, in bounded memory."""

import hashlib
import tracemalloc

from terraflux.sources.scans import file_digests, sha256_of

HUGE = 3 << 30


def _zeros(n):
    digest, piece = hashlib.sha256(), bytes(1 << 24)
    for _ in range(n // len(piece)):
        digest.update(piece)
    digest.update(bytes(n % len(piece)))
    return digest.hexdigest()


def test_files_beyond_two_gibibytes(spark, tmp_path):
    (tmp_path / "in ner").mkdir()
    with open(tmp_path / "in ner" / "huge file.nc", "wb") as f:
        f.truncate(HUGE + 5)
    (tmp_path / "small.csv").write_bytes(b"a,b\n1,2\n")
    (tmp_path / "empty").write_bytes(b"")
    got = {r.path.rpartition("/")[2]: r.sha256 for r in file_digests(spark, str(tmp_path)).collect()}
    assert got == {"huge file.nc": _zeros(HUGE + 5), "small.csv": hashlib.sha256(b"a,b\n1,2\n").hexdigest()}


def test_a_long_file_is_never_held(tmp_path):
    with open(tmp_path / "long", "wb") as f:
        f.truncate(1 << 28)
    tracemalloc.start()
    assert sha256_of(f"file:{tmp_path}/long") == _zeros(1 << 28)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 1 << 25


def test_both_reads_agree(spark, tmp_path):
    for i in range(50):
        (tmp_path / f"ä {i}%20.txt").write_bytes(bytes(range(256)) * i)
    short = {tuple(r) for r in file_digests(spark, str(tmp_path)).collect()}
    assert short == {tuple(r) for r in file_digests(spark, str(tmp_path), streamed_above=-1).collect()} and len(short) == 49  # the first is empty
