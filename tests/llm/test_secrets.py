import base64
import gzip
import hashlib
import re
import zlib

from lakesteward.llm import secrets as sc
from lakesteward.llm.tables import table

KEY = "AKIA" + "Z9" * 8
VALUE = "hunter2hunter2"


def _brute(text):
    found = []
    for m in re.finditer(r"""((?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd])|(?:[Pp][Aa][Ss][Ss][Ww][Dd])|(?:[Ss][Ee][Cc][Rr][Ee][Tt])|(?:[Tt][Oo][Kk][Ee][Nn])|(?:[Aa][Pp][Ii]_?[Kk][Ee][Yy]))["']? *[:=] *["']?([A-Za-z0-9+/_.=-]+)""", text):
        if len(m[2]) >= 8:
            found.append((m.start(), 0, m.end()))
    found += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    found += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(found)


def test_base_spans_of_the_table(spark, sf_dir):
    docs = table(spark, sf_dir.replace("sf0.001", "sf0.01"), "documents")
    texts = {r.doc_id: r.text for r in docs.collect()}
    hits = 0
    for r in sc.secret_spans(docs).collect():
        base = _brute(texts[r.doc_id])
        hits += len(base)
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(k == i for _, k, _ in base) for i in range(3)]
        assert r.base_sha256 == hashlib.sha256(sc.span_text(base).encode()).hexdigest()
        assert set(sc.span_text(base).split(",")) <= set(r.spans.split(","))
    assert hits > 20


def test_base_patterns_on_tricky_texts():
    for text in ["token=secret: abcdefghij", "ſecret=abcdefghij", "toKen=abcdefghij", f"x{KEY}AKIA", "AKIAAKIA12", "API_KEY : 'abcdefgh'",
                 "apikey=abc", "a" * 31 + "é" + "f" * 32, "password = \n abcdefghij", "é" * 9 + f"token={VALUE} {KEY}"]:
        assert sc.scan_text(text) == _brute(text), text


def _all(text):
    return sc.find_secrets(text)[1]


def test_layers():
    secret = f"password={VALUE}"
    lead = "Ünder "
    once = lead + secret.replace("=", "%3D") + " end"
    assert _all(once) == {(6, 0, 6 + len(secret) + 2)}
    deep = lead + secret.replace("=", "%2525253D")
    assert _all(deep) == {(6, 0, len(deep))}
    escaped = lead + "".join(f"\\u{ord(c):04x}" for c in secret)
    assert _all(escaped) == {(6, 0, len(escaped))}
    inner = base64.b64encode(f"some text {KEY} more".encode()).decode()
    (start, kind, end), = _all(f"x {inner} y")
    assert kind == 1 and 2 <= start and end <= 2 + len(inner)
    cut = base64.b64decode(inner)[(start - 2) * 3 // 4:-(-(end - 2) * 3 // 4)]
    assert KEY.encode() in cut
    for packed in (zlib.compress(secret.encode()), gzip.compress(secret.encode())):
        twice = base64.b64encode(base64.b64encode(packed)).decode()
        assert _all(f"x {twice} y") == {(2, 0, 2 + len(twice.rstrip("="))), } or _all(f"x {twice} y") == {(2, 0, 2 + len(twice))}
    url_safe = base64.urlsafe_b64encode(f"??>>{secret}??>>".encode()).decode()
    assert {k for _, k, _ in _all(url_safe)} == {0}
    nested = base64.b64encode(secret.replace("=", "%3D").encode()).decode()
    assert {k for _, k, _ in _all(nested)} == {0}


def test_no_secret_in_prose_or_bombs():
    assert _all("The %20 quick brown fox 100% of THBLELYOUINGNDENINERERTION/and/some/path\\x41") == set()
    bomb = base64.b64encode(zlib.compress(zlib.compress(b"0" * (1 << 25)))).decode()
    assert sc.find_secrets(bomb)[2] or _all(bomb) is not None
    assert _all("%25" * 30_000 + "41") == set()
    assert _all("=" * 50_000 + "QUFB" * 20_000) == set()


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (None, f"token={VALUE}"), (4, f"token={VALUE}"), (4, f"token={VALUE}"), (5, "x " * 200_000 + KEY)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("spans", sc_lit())
    found = sorted(((r.doc_id or 0), r.spans) for r in sc.secret_spans(docs).collect())
    assert found == [(0, "assign:0:20"), (1, ""), (2, ""), (4, "assign:0:20"), (4, "assign:0:20"), (5, "access:400000:400020")]
    assert sc.secret_spans(docs.limit(0)).count() == 0


def sc_lit():
    from pyspark.sql import functions as F

    return F.lit("clash")


def _noise(size):
    return "".join(hashlib.sha256(str(i).encode()).hexdigest()[:20] + " zz " for i in range(size // 24))


def test_wrapped_base64_is_one_layer():
    secret = f"password={VALUE}"
    for data in (f"{'some words ' * 4}{secret}{' more words' * 20}".encode(), gzip.compress((_noise(1200) + secret).encode()),
                 zlib.compress((_noise(1200) + secret).encode())):
        whole = base64.b64encode(data).decode()
        for width in (40, 64, 76):
            for sep in ("\n", "\r\n", "%0A", "\\n"):
                body = sep.join(whole[i:i + width] for i in range(0, len(whole), width))
                for around in ("{}", "x: {} y", "-----BEGIN CERTIFICATE-----\n{}\n-----END", "{}\nThanks for it"):
                    text = around.format(body)
                    at = text.index(body)
                    spans = [s for s in _all(text) if s[1] == 0]
                    assert len(spans) == 1 and at <= spans[0][0] < spans[0][2] <= at + len(body), (width, sep, around)


def test_further_members_and_layers_beyond_a_piece(monkeypatch):
    secret = f"password={VALUE}".encode()
    two = base64.b64encode(gzip.compress(b"nothing here") + gzip.compress(secret)).decode()
    assert {k for _, k, _ in _all(two)} == {0}
    long = base64.b64encode(zlib.compress(b"some words " * 1_600_000 + secret + b" " + base64.b64encode(b"text " + KEY.encode()) + b" end" * 9)).decode()
    base, spans, cut = sc.find_secrets(long)
    assert {k for _, k, _ in spans} == {0, 1} and not cut
