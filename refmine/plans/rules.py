"""Rules in a model's place, for the queries over the test tables."""

from __future__ import annotations

import json
import re
from collections.abc import Callable

from refmine.model.client import CONTEXT_MARK, TITLE_MARK

# A capitalised made-up word followed by one of these is taken for a dataset's name.
_KINDS = "Tree Survey|Street Scenes|Land Atlas|Speech Corpus|Parallel Text|Table Bank|Soil Archive|Relation Graph|Query Collection|Weather Grid|Protein Index|Image Set|Sensor Records|Patent Links|Reading Logs|Dialogue Turns|Household Panel|Bench|QA"
NAME_RULE = rf"[A-Z][a-z]+ (?:{_KINDS})"


def extraction_rule(user: str) -> str:
    """Names by NAME_RULE within the context, with confidence 0.9 for one name and 0.7 for more."""
    context = user.partition(CONTEXT_MARK)[2].partition("\n")[0]
    names = re.findall(NAME_RULE, context)
    labels = {"citation intent": ["background"], "resource type": ["dataset"] * bool(names), "dataset labels": names, "dataset_descriptions": {n: context[:40] for n in names}}
    return "Result: " + json.dumps(labels | {"confidence": 0.9 if len(names) == 1 else 0.7, "reasoning": "rule"})


def relevance_rule(word: str) -> Callable[[str], str]:
    """Relevant if the title holds the word; confidence 0.8 with an early mention, else 0.4."""

    def rule(user: str) -> str:
        title = user.partition(TITLE_MARK)[2].partition("\n")[0].lower()
        at = title.find(word)
        return json.dumps({"relevant": at >= 0, "confidence": 0.8 if 0 <= at < 30 else 0.4, "reason": "rule"})

    return rule
