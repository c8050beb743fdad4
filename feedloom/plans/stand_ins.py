"""Batch functions that need no service, as test inputs of the registered queries."""

from __future__ import annotations


def keyword_rules(rows: list[dict]) -> list[dict]:
    """A batch function without any service: attributes by simple rules, for tests and dry runs."""
    out = []
    for row in rows:
        words = [w for w in (row.get("description") or "").lower().split() if w.isalpha()]
        longest = sorted(set(words), key=lambda w: (-len(w), w))
        out.append(
            {
                "ai_title": (row.get("title") or "").strip().title(),
                "ai_description": " ".join(words[:40]),
                "ai_job_tasks": longest[:3],
                "ai_search_terms": longest[:5],
                "ai_top_tags": longest[:3],
                "ai_skills": longest[:4],
                "sector_id": 1 + len(words) % 3,
                "industry_group_id": 1 + len(words) % 5,
                "industry_id": 1 + len(words) % 8,
                "confidence_score": float(min(100, len(set(words)))),
                "reasoning_industry": "by word count",
                "reasoning_confidence": "by distinct words",
            }
        )
    return out


def first_function(rows: list[dict]) -> list[dict]:
    """A batch function that takes the first listed job function."""
    return [
        {"job_function_id": int(list(r["function_ids"])[0]), "reasoning": "first of the list"} for r in rows
    ]


def joined_terms(rows: list[dict]) -> list[dict]:
    """A batch function that joins the distinct terms of a posting."""
    out = []
    for row in rows:
        terms = [t for name in ("ai_top_tags", "ai_search_terms", "ai_skills") for t in (row.get(name) if row.get(name) is not None else [])]
        out.append({"searchable_text": ", ".join(dict.fromkeys(terms))})
    return out
