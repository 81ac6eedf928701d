"""Landing: byte-equal copies, refused overlaps, a switch that keeps the old files on failure."""

import os
import pathlib

import pytest

from spendstar.plans import pipeline as P
from spendstar.sources import landing as L

DATA = {"a.csv": b"x,y\r\n 1 ,\"two\nlines\"\r\n", "b.csv": b"\xef\xbb\xbfx\n\n\xff\xfe", "empty.csv": b"", "c d%20.csv": os.urandom(100_000)}


@pytest.fixture
def raw(scratch):
    folder = pathlib.Path(scratch, "raw")
    folder.mkdir()
    for name, data in DATA.items():
        (folder / name).write_bytes(data)
    (folder / "_SUCCESS").write_bytes(b"")
    return folder


def landed(place):
    return {p.name: p.read_bytes() for p in pathlib.Path(place).iterdir() if not p.name.startswith(".")}


@pytest.mark.parametrize("pattern", ["", "/*.csv"])
def test_files_arrive_byte_for_byte(spark, scratch, raw, pattern):
    assert L.land(spark, f"{raw}{pattern}", f"{scratch}/landing") == f"{scratch}/landing"
    assert landed(f"{scratch}/landing") == DATA
    # again, with one file less: the folder is replaced as a whole
    (raw / "b.csv").unlink()
    L.land(spark, f"{raw}{pattern}", f"{scratch}/landing")
    assert landed(f"{scratch}/landing") == {k: v for k, v in DATA.items() if k != "b.csv"}
    assert sorted(p.name for p in pathlib.Path(scratch).iterdir()) == ["landing", "raw"]


def test_one_file_beside_its_landing(spark, raw):
    L.land(spark, f"{raw}/a.csv", f"{raw}/landed")
    assert landed(raw / "landed") == {"a.csv": DATA["a.csv"]}


def test_large_files_go_in_blocks(spark, scratch, monkeypatch):
    pathlib.Path(scratch, "big.csv").write_bytes(os.urandom(3 * L.BLOCK + 17))
    L.land(spark, f"{scratch}/big.csv", f"{scratch}/landing")
    assert pathlib.Path(scratch, "landing/big.csv").read_bytes() == pathlib.Path(scratch, "big.csv").read_bytes()


def test_a_glob_over_its_own_target_is_refused(spark, raw):
    L.land(spark, f"{raw}/*", f"{raw}/landed")
    before = landed(raw / "landed")
    with pytest.raises(ValueError, match="overlap"):
        L.land(spark, f"{raw}/*", f"{raw}/landed")
    assert landed(raw / "landed") == before


def test_overlaps_and_missing_sources_are_refused(spark, scratch, raw):
    for source, place in ((raw, raw), (raw, raw / "below"), (raw, scratch), (raw / "a.csv", raw / "a.csv"), (raw / "a.csv", raw)):
        with pytest.raises(ValueError):
            L.land(spark, str(source), str(place))
    with pytest.raises(FileNotFoundError):
        L.land(spark, f"{scratch}/nowhere/*.csv", f"{scratch}/landing")
    assert {k: v for k, v in landed(raw).items() if k != "_SUCCESS"} == DATA


def test_equal_names_from_several_folders(spark, scratch):
    for k in range(2):
        pathlib.Path(scratch, f"day{k}").mkdir()
        pathlib.Path(scratch, f"day{k}", "x.csv").write_text(str(k))
    L.land(spark, f"{scratch}/day*", f"{scratch}/landing")
    assert sorted(landed(f"{scratch}/landing").values()) == [b"0", b"1"]


def test_a_failed_copy_keeps_what_was_landed(spark, scratch, raw, monkeypatch):
    L.land(spark, f"{raw}/a.csv", f"{scratch}/landing")
    monkeypatch.setattr(L, "_switch", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError, match="lost"):
        L.land(spark, str(raw), f"{scratch}/landing")
    assert landed(f"{scratch}/landing") == {"a.csv": DATA["a.csv"]}
    assert sorted(p.name for p in pathlib.Path(scratch).iterdir()) == ["landing", "raw"]


def test_the_switch_puts_the_old_folder_back(spark, scratch):
    from spendstar.sources.files import Files

    pathlib.Path(scratch, "old").mkdir()
    with pytest.raises(Exception):
        L._switch(Files(spark), f"{scratch}/not-there", f"{scratch}/old", f"{scratch}/before")
    assert pathlib.Path(scratch, "old").exists()


def test_a_run_needs_its_credentials_before_it_claims_its_folder(spark, scratch):
    for _ in range(2):
        with pytest.raises(ValueError, match="needs the Hadoop setting"):
            P.run(spark, "abfss://raw@acct/x.csv", f"{scratch}/wh", run_id="r", credential_conf="fs.azure.account.key.acct")
    assert not os.path.exists(f"{scratch}/wh")
