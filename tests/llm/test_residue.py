import re

import pytest

from tallymark.llm import residue
from tallymark.llm.residue import find_residue, judge

LOREM = "Lorem ipsum dolor sit amet. Consectetur adipiscing elit sed."
RESIDUE = [
    "404: Not Found", "HTTP/1.1 503 Service Unavailable\r\nServer: x\r\nContent-Type: text/html\r\n\r\nThe server took too long to answer. Try again in a few minutes.",
    '<html>\n<head><title>502 Bad Gateway</title></head>\n<body>\n<h1>502 Bad Gateway</h1>\n<hr><address>abc/1.2</address>\n</body>\n</html>', '{"message": "Forbidden", "status": 403, "request_id": "ab12cd34ef"}',
    '<?xml version="1.0"?>\n<Error><Code>NoSuchKey</Code><Message>The requested URL was not found.</Message><RequestId>1b94</RequestId></Error>', "curl: (28) timed out waiting for a.example.test",
    "Kelor code viewer\n\nPlease enable JavaScript to continue.\n\nSkip to content | Sign in | Help\n", "Bitte aktivieren Sie JavaScript, um diese Seite anzuzeigen.", "请启用 JavaScript 后重试", "Страница не найдена.",
    "TBD.\nTBD.\n", "-- Coming soon.\n-- Your description here.\n", LOREM, f"<ul>\n  <li>{LOREM}</li>\n  <li>xxxx xxxx</li>\n</ul>", f"# Ilbo\n\n{LOREM}\n", "// mirrored from abc\nAccess to this project is denied; contact the owner.",
    "name: {{project_name}}\nsummary: {{summary}}\nlicense: {{license_name}}\n", 'Copyright (c) <year> <your organisation>\n\nUse of <your project name> is granted.\n', '{\n "name": "%%PACKAGE%%",\n "version": "%%VERSION%%"\n}',
    "package ${PACKAGE};\n\n/**\n * ${VERSION}\n * @author ${AUTHOR}\n */\npublic class ${MODULE} {\n}\n", "", "﻿ \n",
]
REAL = [
    'MESSAGES = {\n    404: "Not Found",\n}\n\n\ndef code_of(x):\n    return MESSAGES.get(x)\n', 'export function onError(res) {\n  res.status(404).send("404 Not Found: Oops! Something went wrong on our end.");\n}\n',
    '# Troubleshooting\n\nIf the viewer shows "Please enable JavaScript to continue.", allow scripts for your own host and reload. A 404 after an upload usually means that the ledger is too large.\n',
    '<!DOCTYPE html>\n<body>\n<noscript>Please enable JavaScript to continue.</noscript>\n<main><h2>ledger table</h2><p>older files lack the row column</p></main></body>',
    f'FILLER = "{LOREM}"\n\n\ndef test_wrap():\n    assert wrap(FILLER, 20)\n', 'name: build\non: [push]\njobs:\n  a:\n    runs-on: ${{ matrix.os }}\n    steps:\n      - run: make REF=${{ github.ref }}\n',
    "#!/bin/sh\nset -eu\nVERSION=\"${VERSION:-1}\"\nfor f in \"${DIR}\"/*.gz; do\n  gunzip -c \"$f\"\ndone\n", "all:\n\tmake -C value\n", '{"port": 8080, "name": "ledger"}', "*.bin binary\n", "Returns the rate for a given hub — ok.\n",
    '{% extends "base.j2" %}\n{% block row %}\n<li>{{ x.freight | e }}: {{ x.rate }}</li>\n{% endblock %}\n',
]


@pytest.mark.parametrize("text", RESIDUE[:-2])
def test_residue(text):
    v = judge(text, "src/core/read_hub.py")
    assert not v.own and v.evidence and len(v.unknown) <= 3, (v.unknown, v.titles)


@pytest.mark.parametrize("text", REAL)
def test_real_files(text):
    v = judge(text, "src/core/read_hub.py")
    assert v.own or v.unknown


@pytest.mark.parametrize("path", ["src/errors.js", "i18n/en.json", "docs/faq.md", "web/templates/x.j2"])
def test_files_about_such_texts(path):
    assert judge("404: Not Found", path).own


SCHEMA = "doc_id bigint, text string, repo string, path string, host string, unknown int, segment string"


def docs(spark, texts, repo="r", path="src/core/read_hub.py"):
    return spark.createDataFrame([(i, t, repo if isinstance(repo, str) or repo is None else repo(i), path, "x", 1, "y") for i, t in enumerate(texts)], SCHEMA)


def test_operator(spark):
    texts = RESIDUE + [None] + REAL
    got = {r.doc_id for r in find_residue(docs(spark, texts)).collect()}
    clear = {i for i, t in enumerate(RESIDUE) if t.strip("﻿ \n") and not judge(t, "src/core/read_hub.py").unknown}
    assert clear <= got and len(clear) >= 17
    assert not {i for i in got if i >= len(RESIDUE)}


def test_host_evidence(spark):
    """Unknown wording beside a status title counts once it recurs over hosts; copies on one host do not."""
    page = "<html><title>500</title><body><h1>500</h1><p>Kwyjibo handlers have left the building.</p></body></html>"
    assert find_residue(docs(spark, [page] * 6, repo="one")).count() == 0
    assert find_residue(docs(spark, [page] * 6, repo=lambda i: f"r{i}")).count() == 6
    assert find_residue(docs(spark, [page] * 6, repo=lambda i: f"r{i}", path="docs/kwyjibo.md")).count() == 0
    assert find_residue(docs(spark, [page] * 6, repo=None)).count() == 0


def test_nulls_repeats_long_and_empty(spark):
    rows = [(1, "TBD.", None, None, "x", 1, "y"), (1, "TBD.", None, None, "x", 1, "y"), (None, "TBD.", "r", "p", None, None, None), (2, None, None, None, None, None, None), (3, "  \n", "r", "p", None, None, None), (4, LOREM * 20_000, "r", "p", None, None, None), (5, LOREM * 20_000 + " own words of the ledger here." * 40, "r", "p", None, None, None)]
    got = sorted((r.doc_id or 0) for r in find_residue(spark.createDataFrame(rows, SCHEMA)).collect())
    assert got == [0, 1, 1, 4]
    assert find_residue(spark.createDataFrame([], SCHEMA)).count() == 0


def test_long_fixed_wording_ahead_of_the_message(spark):
    """Every line is read: forty lines that recur over hosts are explained, wherever the message stands."""
    names = [f"{a}{b}" for a in "bcdfgklm" for b in ("ando", "elmi", "irtu", "ospa", "ukre")]
    lines = [f"The {n} notice holds here," if i % 2 else f"As {n} puts it" for i, n in enumerate(names)]
    for text in ("\n".join(lines) + "\n\n404 Not Found\n", "404 Not Found\n\n" + "\n".join(lines) + "\n"):
        assert find_residue(docs(spark, [text] * 5, repo=lambda i: f"r{i}")).count() == 5
        assert find_residue(docs(spark, [text] * 5, repo="one")).count() == 0


@pytest.mark.parametrize("path", ["templates/x.md", "lang/y.html", "docs/errors/404.html", "src/gen_text.py"])
def test_names_alone_decide_nothing(spark, path):
    texts = ["404: Not Found", RESIDUE[2], "404: Not Found\n\nThe hub sends this when a ledger is gone.\n", *REAL[:5]]
    assert {r.doc_id for r in find_residue(docs(spark, texts, repo=lambda i: f"r{i}", path=path)).collect()} == {0, 1}


def test_wording_no_detector_knows(spark):
    """A duplicated body without any detector hit: found over hosts and file names; copies of a file, or a page its slug names, are not."""
    body = "<html><head><title>Ojoj</title></head><body><p>Sivua ei ole olemassa, valitettavasti.</p></body></html>"
    rows = lambda hosts, path: [(i, body, f"r{i}" if hosts else "one", path(i), "x", 1, "y") for i in range(6)]
    count = lambda r: find_residue(spark.createDataFrame(r, SCHEMA)).count()
    assert count(rows(True, lambda i: f"src/{'abcdef'[i]}x.md")) == 6
    assert count(rows(False, lambda i: f"src/{'abcdef'[i]}x.md")) == 0
    assert count(rows(True, lambda i: f"src/{'abcdef'[i]}/note.md")) == 0
    assert count(rows(True, lambda i: f"sivua/{'abcdef'[i]}x.md")) == 0
    assert count(rows(True, lambda i: f"ojoj/{'abcdef'[i]}x.md")) == 0


def test_hosts_are_counted_over_all_documents(spark):
    """The wording around one message also stands in files without residue, on other hosts."""
    notice = "Zarf terms hold for all of this."
    texts = [f"404 Not Found\n\n{notice}\n"] + [f"# {notice}\nx{i} = f({i});\n" for i in range(5)]
    assert {r.doc_id for r in find_residue(docs(spark, texts, repo=lambda i: f"r{i}")).collect()} == {0}
    assert find_residue(docs(spark, texts[:3], repo=lambda i: f"r{i}")).count() == 0


def test_title_that_agrees_with_the_slug(spark):
    page = "<html><head><title>Kwyjibo ledger</title></head><body><h1>500</h1><p>Kwyjibo handlers have left the building.</p></body></html>"
    assert find_residue(docs(spark, [page] * 6, repo=lambda i: f"r{i}", path="docs/ledger.md")).count() == 0
    assert find_residue(docs(spark, [page] * 6, repo=lambda i: f"r{i}")).count() == 6


def test_scripts_and_data_alike_in_little_are_no_residue(spark):
    shell, data = ["#!/bin/sh\nset -eu"] * 6, [f'{{"{k}": {i}, "unit": "H1"}}' for i, k in enumerate("abcdef")]
    for texts in (shell, data):
        rows = [(i, t, f"r{i}", f"src/{'abcdef'[i]}x.sh", "x", 1, "y") for i, t in enumerate(texts)]
        assert find_residue(spark.createDataFrame(rows, SCHEMA)).count() == 0


def test_fixed_wording_grows_with_the_corpus(spark, monkeypatch):
    """The number of hosts asked for is a share of all hosts, four at least."""
    page = "<html><title>500</title><body><h1>500</h1><p>Kwyjibo handlers have left the building.</p></body></html>"
    texts = [page] * 6 + [f"x{i} = f({i});" for i in range(40)]
    df = docs(spark, texts, repo=lambda i: f"r{i}")
    assert find_residue(df).count() == 6
    monkeypatch.setattr(residue, "HOST_SHARE", 0.2)
    assert find_residue(df).count() == 0


def test_fast_masks_and_sentences_agree_with_plain_ones():
    texts = ["a1b2c3d4 deadbeef 12ab x0123456789 0123456_ f00dfeed.", "one. two! three? four", "A | B|C · d – e", "見ました。次！", "v1.2 ; f(x) a;", "", "9" * 50 + "abc" * 9]
    for t in texts:
        assert residue._masked(t) == re.sub(r"\d+", "0", re.sub(r"\b(?=[0-9a-f]*\d)[0-9a-f]{6,}\b", "0", t.lower()))
        assert residue._sentences(t) == residue._SENTENCE.split(t)
        assert residue._plain_code(t) == bool(re.search(r"[{}=<>\[\]]|\w\(|\(\)|;\s*$", t))
