"""Unit identities against the values that the data model fixes."""

import json

import pytest

from tidemark.functions import python_side as py
from tidemark.operators import intake

# Units and the three identities that they must have.
UNITS = {
    "text": (
        {"payload_kind": "text", "title": "重要提示", "heading_path": ["重要提示"], "semantic_key": "document_content", "semantic_keys": ["document_content"], "quality_status": "ok", "order_index": 1},
        {"text": "重要提示：公司存在退市风险。"},
        "0035f7615fda3c2fff4fe93799edd2999987ffc7afc8067d78f19ef8c4797ea7",
        "37b37ead76b5b8d62c43f68428f363fb1230bd599e5512c1b1ba02f644d658db",
        "c4948f9f2d03c7edbb3a51e3699092ec3f5102f09b4f788268989e1a3994ac74",
    ),
    "table": (
        {"payload_kind": "table", "title": "应收账款账龄披露", "heading_path": ["第八节 财务报告", "应收账款"], "semantic_key": "receivable_aging", "semantic_keys": ["receivable_aging"], "quality_status": "ok", "order_index": 2},
        {"caption": ["应收账款账龄披露"], "unit": "元", "headers": ["账龄", "期末余额"], "rows": [["1年以内", "100.00"], ["合计", "100.00"]], "notes": ["含追溯调整。"]},
        "15af01ea5e919319fdff7c394486f50ec0e0955a5cbbc200ed13936265f8c17b",
        "1cf4066dbb749f3d8cc33e22ff5e619c040f3aba82772bbabf40224821151f16",
        "a7d7c814b0ad54d6d775238b6e978f246e6c5b3eb3841e007e75aa25ca8f0598",
    ),
    "qa": (
        {"payload_kind": "qa", "title": "投资者关系活动主要内容介绍", "heading_path": ["投资者关系活动记录表"], "semantic_key": "document_content", "semantic_keys": ["document_content"], "quality_status": "needs_review", "order_index": 3},
        {"question": "公司海外收入占比是多少？", "answer": "公司将按定期报告披露相关情况。", "raw_text": "问：公司海外收入占比是多少？\n答：公司将按定期报告披露相关情况。"},
        "a137877582f5c9df33aca0e546d7969943878adcf2482bd949370406dcf870cd",
        "8f787d4f6cf1c05fdcf107ab3ff07e52754ae40bdcc37f4f3e0f9df2d4fbf334",
        "5e2f1e49a3347c836fd41ba97f69540746fc40d55abf750b08d28d5e50eca1eb",
    ),
    "mixed": (
        {"payload_kind": "mixed", "title": "经营情况", "heading_path": ["第三节 管理层讨论与分析", "一、经营情况"], "semantic_key": "revenue", "semantic_keys": ["revenue", "segment_performance"], "quality_status": "ok", "order_index": 4},
        {"parts": [{"order": 12, "text": "正文", "local_heading": ["（一）收入"], "applicability": "applicable"}, {"order": 13, "caption": [], "unit": "元", "headers": ["项目", "金额"], "rows": [["收入", "100"]], "notes": []}]},
        "50e12a3abaac7551e934fdf5a99ca598564a86d9dc6cfe34be6bee294ce1b310",
        "f4d3640f1351e8d7de79b815f42a53cc621d82bcd3680da0d29512b7d825650c",
        "42b9f44c722e5de44f9c8079a38d7d15126e217a7919edaf12385d4602c12993",
    ),
}
SCHEMA = "name string, payload_kind string, title string, heading_path array<string>, semantic_key string, semantic_keys array<string>, quality_status string, order_index int, payload string"


@pytest.mark.parametrize("name", list(UNITS))
def test_identities_are_the_fixed_ones(name):
    fields, payload, *digests = UNITS[name]
    assert py.unit_identity(fields, payload) == tuple("sha256:" + d for d in digests)


def test_identities_of_rows(spark):
    order = SCHEMA.replace(",", "").split()[2:-2:2]
    rows = [(name, *[fields[c] for c in order], json.dumps(payload)) for name, (fields, payload, *_) in UNITS.items()]
    rows += [("broken", "mixed", None, [], "k", ["k"], "ok", 1, '{"parts": []}'), ("not json", "text", None, [], "k", None, "ok", 1, "{"), ("none", "text", None, [], "k", None, "ok", 1, None)]
    out = {r["name"]: r for r in intake.unit_hashes(spark.createDataFrame(rows, SCHEMA)).collect()}
    for name, (_, _, *digests) in UNITS.items():
        found = out[name]
        assert [found["content_hash"], found["query_projection_hash"], found["structure_hash"]] == ["sha256:" + d for d in digests] and found["hash_error"] is None
    for name in ("broken", "not json", "none"):
        assert out[name]["hash_error"] and out[name]["content_hash"] is None


def test_parts_say_the_same_wherever_they_stand():
    fields, payload, content, projection, structure = UNITS["mixed"]
    moved = {"semantic_type": "x", "parts": [part | {"order": 99, "artifact_locator": {"page": 3}} for part in payload["parts"]]}
    assert py.unit_identity(fields, moved) == tuple("sha256:" + d for d in (content, projection, structure))
    noted = {"parts": [payload["parts"][0] | {"quality_status": "bad"}, payload["parts"][1]]}
    assert [a == "sha256:" + b for a, b in zip(py.unit_identity(fields, noted), (content, projection, structure))] == [True, False, True]
    assert py.unit_identity(fields | {"section_keys": ["s"], "applicability": "applicable"}, payload)[1] != "sha256:" + projection
