import re

from chatmill.functions import text as X

SAMPLES = [
    "", "  ", "a", "  a  b ", " x y ", "\x1cA\x1fB\x85", "Ärger\t\n  ÜBER\r\n", "İstanbul ΑΣ", "　wide　",
    "<think>a\nb</think>  Yes", "<THINK>a</Think>B", "<think>open", "x<think>1</think>y<think>2</think>z ", "zero​width",
]


def test_strip_and_normalize_agree_with_python(column):
    assert column(X.strip, SAMPLES) == [s.strip() for s in SAMPLES]
    assert column(X.rstrip, SAMPLES) == [s.rstrip() for s in SAMPLES]
    assert column(X.normalize, SAMPLES) == [" ".join(s.lower().split()) for s in SAMPLES]


def test_space_set_is_that_of_python(column):
    chars = [f"a{chr(c)}b" for c in range(1, 0x3100) if not 0xD800 <= c < 0xE000]
    assert column(X.fold_spaces, chars) == [re.sub(r"\s+", " ", c) for c in chars]


def test_reasoning_blocks(column):
    any_case = column(X.strip_thinking, SAMPLES)
    assert any_case[9:13] == ["Yes", "B", "<think>open", "xyz"]
    assert column(X.strip_think_blocks, SAMPLES)[10] == "<THINK>a</Think>B"
    cases = ['<think>hm</think>[0]', '<think>\nfirst\n\nthen\n</think>\n\n{"city": "Ulm"}', "[0]", ""]
    assert column(X.strip_think_blocks, cases) == ["[0]", '{"city": "Ulm"}', "[0]", ""]


def test_code_fences(column):
    body = '{"a": 1}'
    cases = [f"```json\n{body}\n```", f"```\n{body}\n```", f"~~~json\n{body}\n~~~", body, f"```PYTHON {body}```  ", f"```json\n~~~\n{body}\n~~~\n```", "```", f"{body}\n```\nmore"]
    assert column(X.strip_code_fences, cases) == [body] * 6 + ["", f"{body}\n```\nmore"]


def test_truncate(column):
    cases = ["x" * 44, "x" * 45, "ä" * 46]
    assert column(X.truncate, cases) == ["x" * 44, "x" * 45, "ä" * 44 + "…"]
