import base64
import hashlib
import json
import struct
import zlib

import pytest

from ledgerloom.sources import card_source, cards


def chunk(kind, body):
    return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))


def png(*texts, tail=b""):
    out = cards.SIGNATURE + chunk(b"IHDR", struct.pack(">IIBBBBB", 1, 1, 8, 6, 0, 0, 0))
    for keyword, card in texts:
        raw = card if isinstance(card, bytes) else base64.b64encode(json.dumps(card).encode())
        out += chunk(b"tEXt", keyword.encode() + b"\0" + raw)
    return out + chunk(b"IDAT", zlib.compress(b"\0\0\0\0\0")) + chunk(b"IEND", b"") + tail


def v2(**more):
    return {"spec": "chara_card_v2", "spec_version": "2.0", "data": {k: k for k in (*cards.V1_FIELDS, "creator_notes", "creator")} | {"tags": ["已有标签", "同人"]} | more}


def decode(data, extension=".png"):
    return cards.decode("p", data, extension)


def test_png_statuses():
    good = png(("chara", v2()))
    assert decode(good)["status"] == "valid"
    broken = bytearray(good)
    broken[40] ^= 1
    assert decode(bytes(broken))["status"] == "corrupt_png"
    assert "CRC" in decode(bytes(broken))["detail"]
    assert decode(b"GIF")["status"] == "invalid_png"
    assert decode(png())["status"] == "no_card_metadata"
    assert decode(png(("chara", b"!!!")))["status"] == "metadata_decode_failed"
    assert decode(png(("chara", {"spec": "other"})))["status"] == "unsupported_card_spec"
    assert decode(good[:-6])["status"] == "corrupt_png"


def test_ccv3_before_chara_and_fallback():
    v3 = v2(nickname="nick", group_only_greetings="a, b") | {"spec": "chara_card_v3"}
    row = decode(png(("chara", v2()), ("ccv3", v3)))
    assert (row["metadata_chunk"], row["version"], row["card"]["nickname"], row["card"]["group_only_greetings"]) == ("ccv3", 3, "nick", ["a", "b"])
    assert decode(png(("chara", v2()), ("ccv3", b"%")))["metadata_chunk"] == "chara"


def test_json_and_hash_ignores_dates():
    a, b = v2(), v2(create_date="today")
    x, y = decode(png(("chara", a))), decode(json.dumps(b).encode(), ".json")
    assert x["card_sha256"] == y["card_sha256"]
    assert decode(b"\xff", ".json")["status"] == decode(b"{", ".JSON")["status"] == "json_decode_failed"
    assert decode(b"\xef\xbb\xbf" + json.dumps(a).encode(), ".json")["status"] == "valid"
    assert decode(b"[1]", ".json")["status"] == "unsupported_card_spec"


def test_versions_coercion_and_warnings():
    v1 = dict.fromkeys(cards.V1_FIELDS, "x") | {"creatorcomment": "c", "tags": "a, ,b", "system_prompt": "gone", "fav": True}
    card = decode(json.dumps(v1).encode(), ".json")["card"]
    assert (card["spec_version"], card["creator_notes"], card["tags"], card["system_prompt"], card["fav"], card["nickname"]) == ("1.0", "c", ["a", "b"], "", True, None)
    row = decode(json.dumps(v2(name=5, tags=3, scenario=[1, None, 2], personality={"a": 1})).encode(), ".json")
    assert row["status"] == "valid_with_warnings"
    assert row["warnings"] == ["name is not a string", "personality is not a string", "scenario is not a string", "tags is neither a string nor an array"]
    assert (row["card"]["name"], row["card"]["scenario"], row["card"]["personality"], row["card"]["tags"]) == ("5", "1,,2", "[object Object]", [])
    missing = decode(json.dumps({"spec": "chara_card_v2"}).encode(), ".json")
    assert missing["status"] == "unsupported_card_spec" and missing["card_sha256"] and missing["card"] is None
    notes = v2(creator_notes_multilingual={"en": "english"}) | {"spec": "chara_card_v3"}
    assert cards.extract(notes, 3)["creator_notes"] == "english"


def test_base64_without_padding():
    raw = base64.b64encode(json.dumps(v2(name="x")).encode()).rstrip(b"=")
    assert decode(png(("chara", raw)))["status"] == "valid"


def test_tags():
    data = png(("chara", v2()), ("ccv3", v2() | {"spec": "chara_card_v3"}), ("chara", b"%"), tail=b"rest")
    out, added, count = cards.write_tags(data, ".png", ["同人", "原神", " 原神 "])
    assert added == ["原神"] and count == 2 and out.endswith(b"rest") and b"%" in out
    assert decode(out)["card"]["tags"] == ["已有标签", "同人", "原神"]
    text, added, count = cards.write_tags(json.dumps(v2()).encode(), ".json", ["x"], replace=True)
    assert added == ["x"] and count is None and text.endswith(b"}\n") and json.loads(text)["data"]["tags"] == ["x"]
    with pytest.raises(cards.Unreadable):
        cards.write_tags(png(), ".png", ["x"])


def test_scan_and_tag_files(spark, tmp_path):
    (tmp_path / "a" / "b").mkdir(parents=True)
    (tmp_path / "a" / "x.PNG").write_bytes(png(("chara", v2())))
    (tmp_path / "a" / "b" / "y.json").write_text(json.dumps(v2(create_date=1)))
    (tmp_path / "z.txt").write_text("no")
    files = cards.list_files(spark, f"file://{tmp_path}")
    rows = {r.relative_path: r for r in cards.scan(files).collect()}
    assert set(rows) == {"a/x.PNG", "a/b/y.json"} and rows["a/x.PNG"].extension == ".png"
    assert rows["a/x.PNG"].card_sha256 == rows["a/b/y.json"].card_sha256 and rows["a/x.PNG"].card.name == "name"
    sha = hashlib.sha256((tmp_path / "a" / "x.PNG").read_bytes()).hexdigest()
    tags = spark.createDataFrame([("a/x.PNG", sha, ["原神"], False), ("a/b/y.json", "0" * 64, ["原神"], False)], "relative_path string, sha256 string, tags_to_add array<string>, copy_unchanged boolean")
    out = {r.relative_path: r for r in cards.tag_files(files, tags).collect()}
    assert out["a/x.PNG"].tags_actually_added == ["原神"] and out["a/b/y.json"].status == "source_invalid"
    kept = cards.tag_files(files, spark.createDataFrame([("a/x.PNG", sha, ["原神"], True)], tags.schema)).first()
    assert kept.output_sha256 == kept.source_sha256 == sha


def test_the_data_source_gives_what_a_scan_gives(spark, tmp_path):
    """Whole files give the rows of a scan; by ranges a damaged image is not seen, and is not read."""
    good = png(("chara", v2()))
    large = cards.SIGNATURE + chunk(b"IHDR", bytes(13)) + chunk(b"IDAT", bytes(100_000)) + chunk(b"tEXt", b"ccv3\0" + base64.b64encode(json.dumps({"spec": "chara_card_v3", "data": {"name": "n"}}).encode())) + chunk(b"IEND", b"")
    damaged = bytearray(large)
    damaged[500] ^= 1
    files = {"a/good.PNG": good, "large.png": large, "damaged.png": bytes(damaged), "cut.png": large[:-20], "short.png": good[:5], "no.png": png(), "v.json": json.dumps(v2()).encode(), "bad.JSON": b"{", "other.txt": b"x", "empty.png": b""}
    for name, data in files.items():
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_bytes(data)
    card_source.register(spark)
    columns = [c for c in card_source.FIELDS if c != "bytes_read"]
    rows = lambda df: {r.relative_path: r for r in df.select(columns).collect()}
    wanted = rows(cards.scan(cards.list_files(spark, f"file://{tmp_path}")))
    (tmp_path / "link.png").symlink_to(tmp_path / "large.png")
    got = rows(spark.read.format("card_files").load(str(tmp_path)))
    empty = got.pop("empty.png")  # Spark's own reader leaves empty files out
    assert (empty.status, empty.size_bytes) == ("invalid_png", 0) and got == wanted and len(got) == 8
    ranged = spark.read.format("card_files").option("verify", "cards").load(f"file://{tmp_path}").collect()
    by = {r.relative_path: r for r in ranged}
    assert by["damaged.png"].status == "valid" and got["damaged.png"].status == "corrupt_png"
    assert by.pop("empty.png").status == "invalid_png"
    assert {p: r.status for p, r in by.items() if p != "damaged.png"} == {p: r.status for p, r in got.items() if p != "damaged.png"}
    assert by["large.png"].card == got["large.png"].card and by["large.png"].card_sha256 == got["large.png"].card_sha256
    assert by["large.png"].bytes_read < 1000 and by["large.png"].sha256 is None and by["v.json"].sha256 == got["v.json"].sha256
    with pytest.raises(Exception, match="all or cards"):
        spark.read.format("card_files").option("verify", "some").load(str(tmp_path)).count()


def test_listing_gives_what_sparks_own_source_gives(spark, tmp_path):
    """Names with spaces and signs, levels of folders, links, hidden and empty files."""
    root = tmp_path / "a b%20 +ü"
    names = ["x.png", "a/y.JSON", "a/b c/d%41/z.Json", "a/b c/w.png", "_hidden.json", "_kept=1.json", ".dot/x.json", "_gone/x.json", "_metadata_of/x.json", "_metadata.json", "k=v/x.json", "n.txt", "png", "cut.json._COPYING_"]
    for name in names:
        (root / name).parent.mkdir(parents=True, exist_ok=True)
        (root / name).write_bytes(name.encode())
    (root / "empty.json").touch()
    (root / "link.json").symlink_to(root / "x.png")
    (root / "linked").symlink_to(root / "a" / "b c")
    (root / "broken.json").symlink_to(root / "nothing")
    own = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(f"file://{root}").filter("lower(path) rlike '[.](png|json)$'").collect()
    want = {r.path.removeprefix(f"file:{root}/"): (r.length, r.modificationTime.strftime("%Y-%m-%dT%H:%M:%S.%f")[:-3] + "Z", bytes(r.content)) for r in own}
    got = cards.list_files(spark, f"file://{root}").collect()
    assert {r.relative_path: (r.size_bytes, r.modified_utc, bytes(r.content)) for r in got} == want and len(got) == len(want) == 10
    assert {(r.file_name, r.extension) for r in got} >= {("z.Json", ".json"), ("_kept=1.json", ".json"), ("w.png", ".png")}
    assert {r.path for r in cards.list_paths(spark, f"file://{root}").collect()} == {f"{root}/{name}" for name in want}
    with pytest.raises(FileNotFoundError):
        cards.list_files(spark, f"file://{root}/nothing")


def test_small_files_are_dealt_to_few_tasks(spark, tmp_path, monkeypatch):
    """The tasks of a listing follow the number and the bytes of its files, not what Spark reckons for opening each; large contents come in slices."""
    for i in range(120):
        (tmp_path / f"d{i % 7}").mkdir(exist_ok=True)
        (tmp_path / f"d{i % 7}" / f"{i}.json").write_text(str(i) * 50)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4m")
    try:
        files = cards.list_files(spark, str(tmp_path))
        assert files.rdd.getNumPartitions() == cards.list_paths(spark, str(tmp_path)).rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    monkeypatch.setattr(cards, "FILES", 20)
    monkeypatch.setattr(cards, "SLICE", 300)
    many = cards.list_files(spark, str(tmp_path))
    assert many.rdd.getNumPartitions() == 6
    want = {(f"d{i % 7}/{i}.json", (str(i) * 50).encode()) for i in range(120)}
    assert [{(r.relative_path, bytes(r.content)) for r in df.collect()} == want for df in (files, many)] == [True, True]
    assert many.count() == 120
