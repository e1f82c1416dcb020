import hashlib
import re

from pyspark.sql import functions as F

from histkit.llm.queries import op3_secrets
from histkit.llm.secrets import find_secrets, mask
from tests.llm.small import SCHEMA, SF, empty, frame, odd, rows

ASSIGN = re.compile(
    r"""((?:[pP][aA][sS][sS][wW][oO][rR][dD])|(?:[pP][aA][sS][sS][wW][dD])|(?:[sS][eE][cC][rR][eE][tT])|"""
    r"""(?:[tT][oO][kK][eE][nN])|(?:[aA][pP][iI]_?[kK][eE][yY]))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)


def base(text):
    text = text or ""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(found)


def digest(text):
    found = base(text)
    listed = ",".join(f"{('assign', 'access', 'hex')[k]}:{s}:{e}" for s, k, e in found)
    return [sum(f[1] == k for f in found) for k in range(3)] + [hashlib.sha256(listed.encode()).hexdigest()]


def check(out, texts):
    key = lambda r: (str(r[0]), *map(str, r[1:]))
    got = [(r["doc_id"], r["n_assign"], r["n_access"], r["n_hex"], r["base_sha256"]) for r in out]
    assert sorted(got, key=key) == sorted(((i, *digest(t)) for i, t in texts), key=key)
    for r in out:
        plain = ",".join(s for s in r["spans"].split(",") if not s.startswith("opaque"))
        assert hashlib.sha256(plain.encode()).hexdigest() == r["base_sha256"]


def table(spark, tmp_path, docs):
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    return str(tmp_path)


HEX = "0123456789abcdef" * 2
HARD = [
    "",
    "token: token: abcdefgh",
    "token=secret=abcdefgh12",
    "API_KEY='abcdefgh' apikey = \"12345678\"x",
    "password: short secret:longenough.",
    f"{HEX} {HEX}a{HEX} g{HEX}",
    f"😀 é token = \"{HEX}\" 日本 AKIA{'A' * 12} AKIA{'B' * 11} AKIAAKIAAKIAAKIA",
    "PassWord:=abcdefgh passwd=abcdefg",
    "tokentoken=aaaaaaaa",
    "ſecret=abcdefgh toKen=abcdefgh",
    f"token={HEX}",
    "a" * 40 + " password=abcdefgh" * 50,
]


def test_hard_texts(spark, tmp_path):
    docs = frame(spark, list(enumerate(HARD)))
    check(op3_secrets(spark, table(spark, tmp_path, docs)).collect(), list(enumerate(HARD)))


def test_query(spark):
    out = op3_secrets(spark, SF).collect()
    texts = [(r["doc_id"], r["text"]) for r in rows()]
    check(out, texts)


def verdicts(spark, items):
    """Per id the (verdict, owners, repositories, kind) of its spans; items are (id, text, source[, lang])."""
    full = [(i, text, rest[1] if len(rest) > 1 else None, rest[0], None) for i, text, *rest in items]
    found = find_secrets(spark.createDataFrame(full, SCHEMA), ["doc_id"]).collect()
    return {r["doc_id"]: [(s["verdict"], s["owners"], s["repositories"], s["kind"]) for s in r["spans"]] for r in found}


RANDOM, OWN, OPAQUE = "k3Jx9Qw2Lm7Zt4Vb", "p8Rn5Yc1Hd6Gs0Fa", "Zk4mQ8xLw2Nv7Rt1Bp5Y"


def test_a_random_value_is_never_an_example(spark):
    items = [(i, f"text {i} password={RANDOM} {OPAQUE}X", f"owner{i % 4}") for i in range(8)]
    out = verdicts(spark, items)
    # the opaque string has too many owners to be told
    assert all(out[i] == [("shared", 4, 4, 0)] for i in range(8))


def test_a_template_value_under_many_owners_is_an_example(spark):
    items = [(i, f"text {i} password=your-password", f"owner{i}") for i in range(3)]
    items += [(10 + i, f"text {i} password=changeme-{i}", "owner0") for i in range(3)]
    out = verdicts(spark, items)
    assert all(out[i] == [("example", 3, 3, 0)] for i in range(3))
    assert all(out[10 + i] == [("unclear", 1, 1, 0)] for i in range(3))


def test_copies_of_one_text_count_once(spark):
    """A credential or a template in a text that many owners copied is still that of one text."""
    items = [(i, f"the text with password={OWN} and token=placeholder", f"owner{i}") for i in range(9)]
    assert all(v == [("live", 1, 1, 0), ("unclear", 1, 1, 0)] for v in verdicts(spark, items).values())


def test_repositories_enter_the_verdict(spark):
    """Boilerplate of one owner's many repositories is an example; a random value of theirs stays live."""
    items = [(i, f"text {i} token=sample-token secret={OWN}", "owner", f"lang{i}") for i in range(8)]
    assert all(v == [("example", 1, 8, 0), ("live", 1, 8, 0)] for v in verdicts(spark, items).values())
    assert all(v[0][0] == "unclear" for v in verdicts(spark, items[:7]).values())


def test_opaque_strings(spark):
    items = [(i, f"text {i} with {OPAQUE}", f"owner{i}") for i in range(2)] + [(5, f"one {OPAQUE}Q", "owner1"), (6, "secret=aaaaaaaaaa", "o")]
    out = verdicts(spark, items)
    assert out[0] == out[1] == [("shared", 2, 2, 3)] and out[5] == [("live", 1, 1, 3)] and out[6][0][0] == "unclear"


def test_mask(spark):
    text = f"é token={HEX} x {HEX}"
    docs = frame(spark, [(1, text), (2, "clean"), (3, None)])
    found = find_secrets(docs, ["doc_id", "text"]).select("doc_id", mask(F.col("text"), F.col("spans")).alias("text"))
    assert {r["doc_id"]: r["text"] for r in found.collect()} == {1: "é [secret] x [secret]", 2: "clean", 3: None}


def test_odd_rows(spark, tmp_path):
    docs = odd(spark)
    out = op3_secrets(spark, table(spark, tmp_path / "odd", docs)).collect()
    check(out, [(r["doc_id"], r["text"]) for r in docs.collect()])
    assert op3_secrets(spark, table(spark, tmp_path / "empty", empty(spark))).collect() == []
