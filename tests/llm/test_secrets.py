import base64
import bz2
import gzip
import hashlib
import lzma
import random
import re
import urllib.parse
import zlib

from creditmart.llm import secrets
from creditmart.llm.queries import LLM_QUERIES

NAMES = "|".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in n) for n in ("password", "passwd", "secret", "token", "apikey", "api_key"))
ASSIGN = re.compile(f"""({NAMES})["']? *[:=] *["']?([A-Za-z0-9+/_.=-]+)""")


def base(text):
    """(start, kind, end) straight from the contract."""
    text = text or ""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(found)


def expected(text):
    found = base(text)
    joined = ",".join(f"{secrets.KINDS[k]}:{a}:{b}" for a, k, b in found)
    return (*(sum(k == i for _, k, _ in found) for i in range(3)), hashlib.sha256(joined.encode()).hexdigest())


def test_query_has_the_base_matches(spark, tables):
    for sf in ("sf0.001", "sf0.1"):
        rows = LLM_QUERIES["op5_secret_scan"](spark, f"/root/testdata/{sf}").collect()
        texts = {r.doc_id: r.text for r in tables("documents", sf).collect()}
        assert {r.doc_id: (r.n_assign, r.n_access, r.n_hex, r.base_sha256) for r in rows} == {d: expected(t) for d, t in texts.items()}
        for r in rows:
            assert {f"{secrets.KINDS[k]}:{a}:{b}" for a, k, b in base(texts[r.doc_id])} <= set(r.spans.split(","))


def test_random_base_matches():
    random.seed(7)
    signs = ["token", "SECRET", "api_key", "apikey", " ", "=", ":", '"', "AKIA", "ABCDEFGH12345678", "abc", "0123456789abcdef", "_", "é", "ſecret", "\n", "-"]
    for _ in range(3000):
        text = "".join(random.choices(signs, k=random.randint(1, 25)))
        found, every, _ = secrets.scan(text)
        assert [(a, secrets.KINDS.index(k), b) for k, a, b in found] == base(text)
        assert {x[:3] for x in every} >= set(found)


def every(text):
    return {(k, text[a:b], "/".join(p)) for k, a, b, p in secrets.scan(text)[1]}


def test_layers():
    plain = "password=hunter2secret"
    coded = base64.b64encode(plain.encode()).decode()
    assert ("assign", coded.rstrip("="), "base64") in {(k, t.rstrip("="), p) for k, t, p in every(f"see {coded} there")}
    quoted = urllib.parse.quote(plain, safe="")
    assert ("assign", quoted, "url") in every(f"x {quoted} y")
    assert ("assign", urllib.parse.quote(quoted, safe=""), "url/url") in every(f"x {urllib.parse.quote(quoted, safe='')} y")
    slash = chr(92)
    escaped = f"{slash}u0070assword{slash}x3dhunter2secret"
    assert ("assign", escaped, "unicode") in every(f"é {escaped} !")
    assert ("assign", "&#112;assword&#x3d;hunter2secret", "unicode") in every("&#112;assword&#x3d;hunter2secret !")
    packed = base64.b64encode(gzip.compress(coded.encode())).decode()
    assert ("assign", packed, "base64/gzip/base64") in every(f'blob "{packed}"')
    wrapped = urllib.parse.quote(base64.b64encode(quoted.encode() + b"9").decode(), safe="")
    assert any(p == "url/base64/url" and t == wrapped for _, t, p in every(f"a {wrapped} b"))
    twice = secrets.scan(f"{coded} and {coded}")[1]
    assert len([x for x in twice if x[3] == ("base64",)]) == 2


def test_circles_bombs_and_bad_layers_end():
    secrets.scan("%25" * 50 + "%zz %ff%fe \\ud800 &#0; &#55296; \\U99999999 \\x41")
    assert not secrets.scan("%2525252541")[2]
    bomb = base64.b64encode(gzip.compress(b"a" * 2_000_000)).decode()
    found = secrets.scan(f"{bomb} token=abcdef123", budget=100_000)
    assert found[2] and ("assign", len(bomb) + 1, len(bomb) + 16, ()) in found[1]
    assert all(0 <= a < b <= len(bomb) for a, b in found[2])
    assert not secrets.scan(f"{bomb} x")[2]


PLAIN = "password=hunter2secret"


def test_base64_beside_other_characters():
    coded = base64.b64encode(PLAIN.encode()).decode()
    for before in ("https://x.example/cb/", "key-", "/", "a_", "ab+", "a/b-c_"):
        for after in ("", " x", "/rest", "-z"):
            found = secrets.scan(f"{before}{coded.rstrip('=')}{after}")[1]
            assert any(a < len(before) + 4 and b >= len(before + coded.rstrip("=")) and p == ("base64",) for _, a, b, p in found)
    # Bytes that are not text, before and after.
    mixed = base64.b64encode(b"\xff\x00\x01" + PLAIN.encode() + b"\x00\xfe").decode()
    assert [(k, p) for k, _, _, p in secrets.scan(mixed)[1]] == [("assign", ("base64",))]


def test_wrapped_base64():
    long = "x, y; " * 8 + PLAIN + ", " * 20 + "token=abcdef777 " + "z, " * 30
    for line_end in ("\n", "\r\n", "\n  "):
        text = "head: " + base64.encodebytes(long.encode()).decode().replace("\n", line_end) + "."
        assert {k for k, _, _, p in secrets.scan(text)[1] if p == ("base64",)} == {"assign"}
        clean = secrets.masked(text, [(a, b) for _, a, b, _ in secrets.scan(text)[1]])
        assert clean.startswith("head: [secret]")
    noise = random.Random(4).randbytes(200).hex().upper()
    for pack in (gzip.compress, zlib.compress, bz2.compress, lzma.compress):
        text = base64.encodebytes(pack((noise + PLAIN).encode())).decode()
        assert any(k == "assign" and p[0] == "base64" and len(p) == 2 for k, _, _, p in secrets.scan(text)[1])


def test_compressed_members():
    for pack in (gzip.compress, bz2.compress, lzma.compress):
        members = pack(b"first " + PLAIN[:8].encode()) + pack(PLAIN[8:].encode()) + b"\0\0\0\0"
        found = secrets.scan("/" + base64.b64encode(members).decode())
        assert not found[2] and [k for k, _, _, p in found[1] if len(p) == 2] == ["assign"]


def test_long_texts_with_escapes_are_whole():
    coded = base64.b64encode(PLAIN.encode()).decode()
    quoted = urllib.parse.quote(PLAIN, safe="")
    text = "one%41escape " + "lorem ipsum, " * 500 + f"{quoted}, {coded} &#65; \\x41 "
    base_, found, skipped = secrets.scan(text, budget=1000)
    assert not skipped and not base_
    assert {(text[a:b], p) for _, a, b, p in found} == {(quoted, ("url",)), (coded, ("base64",))}
    # One stretch that grows too large costs only itself.
    bomb = base64.b64encode(gzip.compress(b"x " * 500_000)).decode()
    text = f"{bomb} {quoted} {bomb} {coded}"
    found = secrets.scan(text, budget=10_000)
    assert {text[a:b] for a, b in found[2]} <= {bomb, bomb.rstrip("=")} and len(found[2]) >= 2
    assert {text[a:b] for _, a, b, _ in found[1]} == {quoted, coded}


def test_stretches_hold_all_that_the_whole_text_would(monkeypatch):
    random.seed(11)
    coded = base64.b64encode(PLAIN.encode()).decode()
    signs = ["token", "secret", "=", ":", " ", " ", "  ", '"', "abcdef", "xyz", "%3D", "%20", "%41", "&#61;", "&#32;", "\\x3d",
             "\\u0020", ",", "é", "\n", "\n\n", "\t", "%0A", "%2B", coded, coded[:13], coded[13:], "AKIAABCDEFGH", "0123456789ab"]
    texts = ["".join(random.choices(signs, k=random.randint(1, 30))) for _ in range(3000)]
    divided = [secrets.scan(text) for text in texts]
    monkeypatch.setattr(secrets, "_BREAK", re.compile("(?!)"))
    spans = lambda found: {x[:3] for x in found[1]}
    for text, found in zip(texts, divided, strict=True):
        assert spans(found) == spans(secrets.scan(text)), text


def test_dirt_and_masks(spark, dirty):
    texts = [None, "", "é token = \"abcdef123\" end", "token=abc", "word " * 20_000 + "AKIA" + "A1" * 8]
    rows = secrets.digest(secrets.find_secrets(dirty(texts))).select("row.doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans").collect()
    assert {r[0]: tuple(r[1:5]) for r in rows} == {i: expected(t) for i, t in enumerate(texts)}
    clean = [r.masked for r in secrets.find_secrets(dirty(texts)).orderBy("row.doc_id").collect()]
    assert clean[:4] == [None, "", 'é [secret]" end', "token=abc"] and clean[4].endswith("word [secret]")
    assert secrets.find_secrets(dirty([])).count() == 0


def test_bad_bytes_cost_only_themselves():
    hexed = "".join(f"%{b:02x}" for b in PLAIN.encode())
    for before, after in (("%ff", ""), ("%e9", "%80"), ("%c3", "%ff%fe"), ("", "%f0%9f")):
        text = f"x {before}{hexed}{after} y"
        found = secrets.scan(text)[1]
        assert any(p == ("url",) and a <= 2 + len(before) and b >= 2 + len(before + hexed) for _, a, b, p in found), text
    units = "".join(f"\\u{ord(c):04x}" for c in PLAIN)
    for before, after in (("\\ud800", ""), ("", "\\udc00"), ("\\udfff\\ud83d", "\\ud83d\\ude00")):
        assert any(p == ("unicode",) for *_, p in secrets.scan(f"{before}{units}{after}")[1])
    assert any(p == ("unicode",) for *_, p in secrets.scan("\\Uffffffff" + "".join(f"\\x{ord(c):02x}" for c in PLAIN))[1])


def deflated(data, window, level=9):
    packer = zlib.compressobj(level, zlib.DEFLATED, window)
    return packer.compress(data) + packer.flush()


def test_other_forms_in_base64():
    long = random.Random(8).randbytes(100).hex().upper() + " " + PLAIN
    raws = {("utf16",): [PLAIN.encode("utf-16"), PLAIN.encode("utf-16-be"), b"\xff" + PLAIN.encode("utf-16-le")]}
    raws["zlib",] = [deflated(long.encode(), window, level) for window in range(9, 16) for level in (1, 6, 9)]
    raws["deflate",] = [deflated(long.encode(), -window) for window in range(9, 16)]
    raws["gzip", "utf16"] = [gzip.compress(long.encode("utf-16-le"))]
    for path, given in raws.items():
        for raw in given:
            coded = base64.b64encode(raw).decode()
            assert any(k == "assign" and p == ("base64", *path) for k, _, _, p in secrets.scan(f"see {coded}, so")[1]), (path, raw)


def test_escaped_packed_data():
    noise = random.Random(9).randbytes(60).hex().upper()
    for name, pack in (("gzip", gzip.compress), ("zlib", zlib.compress), ("bzip2", bz2.compress), ("xz", lzma.compress)):
        raw = pack((noise + " " + PLAIN).encode())
        spelled = {
            "url": [urllib.parse.quote(raw, safe=""), "".join(f"%{b:02X}" for b in raw)],
            "unicode": ["".join(f"\\x{b:02x}" for b in raw), repr(raw)[2:-1]],
        }
        for kind, texts in spelled.items():
            for text in texts:
                found = [(a, b) for k, a, b, p in secrets.scan(f"blob= {text}\n, end")[1] if k == "assign" and p == (kind, name)]
                assert len(found) == 1 and found[0][0] == 6 and found[0][1] >= 6 + len(text) - 12, (kind, name, text)


def test_nested_encoders_with_bad_bytes_around():
    """Every chain of up to four encoders, with bytes that are no text between the layers."""
    rng = random.Random(12)
    noise = [b"", b"\xff", b"\xe9\x00", b"\x80\x81"]

    def coded(data, encoder):
        if encoder == "base64":
            return base64.b64encode(data)
        if encoder == "url":
            return "".join(f"%{b:02x}" for b in data).encode()
        if encoder == "hex":
            return "".join(f"\\x{b:02x}" for b in data).encode()
        return base64.b64encode({"gzip": gzip, "bzip2": bz2, "xz": lzma}[encoder].compress(data))

    for _ in range(400):
        chain = rng.choices(["base64", "url", "hex", "gzip", "bzip2", "xz"], k=rng.randint(1, 4))
        data = PLAIN.encode()
        for encoder in chain:
            # In escapes, a byte above 0x7F beside text reads as a letter or stays an escape; a space ends words.
            data = coded(rng.choice(noise) + b" " + data + b" " + rng.choice(noise), encoder)
        text = "so: " + data.decode() + " ."
        found = [x for x in secrets.scan(text)[1] if x[0] == "assign"]
        assert found, chain
        assert "hunter2" not in secrets.masked(text, [(a, b) for _, a, b, _ in found])


def test_what_was_not_scanned_is_masked(spark, dirty, monkeypatch):
    bomb = base64.b64encode(gzip.compress(b"x " * 500_000)).decode()
    found = dirty([f"a {bomb} b token=abcdef123"])
    monkeypatch.setattr(secrets, "EXPANSION", 2)
    base_, spans, skipped = secrets.scan(f"a {bomb} b token=abcdef123", budget=10_000)
    assert skipped and secrets.masked(f"a {bomb} b", skipped).strip("= ") == "a [secret] b".strip()
    row = secrets.find_secrets(found).first()
    assert row.complete and row.masked == f"a {bomb} b [secret]"
