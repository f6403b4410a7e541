"""Model answers to fixed records, as Python's JSON reader sees them; nothing here raises."""

from __future__ import annotations

import json
import re

_WIDE, _NARROW = re.compile(r"\{.*\}", re.S), re.compile(r"\{[^}]+\}", re.S)
# Fixed values of the answer rules.
DEFAULT_CONFIDENCE, FAILED_CONFIDENCE, EMPTY_CAP = 0.5, 0.3, 0.6


def _strings(value) -> list[str]:
    return [x if isinstance(x, str) else json.dumps(x, ensure_ascii=False) for x in value if x is not None] if isinstance(value, list) else []


def _number(value) -> float | None:
    return float(value) if isinstance(value, (int, float)) else None


def extraction_record(answer: str | None) -> dict:
    """Labels, intents, types, descriptions, confidence and reasoning of one answer.

    From the first to the last brace; labels that aren't a list are none; without labels the
    confidence is at most 0.6; what can't be read, or a confidence that is no number, gives
    no labels and 0.3. Members of other types are written as text, so that one odd answer
    can't fail a job.
    """
    failed = {"datasets": [], "citation_intent": [], "resource_type": [], "descriptions": {}, "confidence": FAILED_CONFIDENCE, "reasoning": "unreadable answer"}
    found = _WIDE.search(answer or "")
    if not found:
        return failed
    try:
        data = json.loads(found[0])
    except ValueError:
        return failed
    confidence = _number(data.get("confidence", DEFAULT_CONFIDENCE))
    if confidence is None:
        return failed
    labels = _strings(data.get("dataset labels"))
    said = data.get("dataset_descriptions")
    return {
        "datasets": labels,
        "citation_intent": _strings(data.get("citation intent")),
        "resource_type": _strings(data.get("resource type")),
        "descriptions": {k: v if isinstance(v, str) else json.dumps(v, ensure_ascii=False) for k, v in said.items() if v is not None} if isinstance(said, dict) else {},
        "confidence": confidence if labels else min(confidence, EMPTY_CAP),
        "reasoning": data["reasoning"] if isinstance(data.get("reasoning"), str) else "",
    }


def relevance_record(answer: str | None) -> dict:
    """(relevant, confidence, reason): the first braces without an inner closing brace.

    Any truthy ``relevant`` counts. Without braces the word "true" decides, at 0.5; what
    can't be read, or a confidence that is no number, is (False, 0).
    """
    text = answer or ""
    found = _NARROW.search(text)
    if not found:
        return {"relevant": "true" in text.lower(), "confidence": DEFAULT_CONFIDENCE, "reason": text[:200]}
    try:
        data = json.loads(found[0])
    except ValueError:
        return {"relevant": False, "confidence": 0.0, "reason": "unreadable answer"}
    confidence = _number(data.get("confidence", 0.0))
    if confidence is None:
        return {"relevant": False, "confidence": 0.0, "reason": "confidence is no number"}
    reason = data.get("reason", "")
    return {"relevant": bool(data.get("relevant", False)), "confidence": confidence, "reason": reason if isinstance(reason, str) else json.dumps(reason)}
