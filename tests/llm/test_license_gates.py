import itertools
import re._parser as parser

import pytest

from millrace.llm import license_rules, licenses


def examples(tree):
    """A text for every combination of the optional branches of a regular expression."""
    parts = []
    for op, arg in tree:
        name = str(op)
        if name == "LITERAL":
            parts.append([chr(arg)])
        elif name == "ANY":
            parts.append(["x"])
        elif name == "IN":
            parts.append([chr(v) for o, v in arg if str(o) == "LITERAL"][:2] or ["x"])
        elif name == "SUBPATTERN":
            parts.append(examples(arg[3]))
        elif name == "BRANCH":
            parts.append([x for b in arg[1] for x in examples(b)])
        else:
            assert name == "MAX_REPEAT", name
            low, high, sub = arg
            one = examples(sub)
            parts.append(([""] if low == 0 else []) + ([x * max(low, 1) for x in one] if high == 1 or low else []))
    return ["".join(p) for p in itertools.product(*parts)]


def test_every_match_passes_its_gate():
    bad = set()
    for number, label, keyword, regex, _, _ in license_rules.rules():
        for text in examples(parser.parse(regex)):
            if keyword not in text or not any(m.replace(" ", "  ") in text for m in license_rules.MARKERS):
                bad.add((number, label, keyword))
    assert not bad


@pytest.mark.parametrize(
    ("text", "label"),
    [
        ("BSD-style license", "bsd"), ("released under the BSD-style licence", "bsd"), ("OpenRAIL-M license", "openrail"), ("Open RAIL-M License", "openrail"),
        ("Open Data Commons Database License", "odbl"), ("Ruby's license", "ruby"), ("may not be reproduced in any form without the prior written permission", "proprietary"),
    ],
)
def test_optional_branches(spark, text, label):
    assert label in licenses.scan_licenses(spark.createDataFrame([(text,)], "text string")).first().licenses.labels.split(",")
