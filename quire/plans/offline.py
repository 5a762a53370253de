"""A deterministic stand-in for a hosted model, for the registered queries and tests only."""

from __future__ import annotations

import json
import re

from quire.operators.inference import Model

_COUNT = re.compile(r"=== NEWSLETTER (\d+) ===")
_FROM = re.compile(r"^From: (.*)$", re.M)


def offline_model(output_tokens: int) -> Model:
    """Answers every prompt with a well-formed digest that names the sources it saw and
    how many messages (or, in a merge, partial answers) the prompt holds."""
    def run(prompts: list[str]) -> list[str]:
        out = []
        for p in prompts:
            n = len(_COUNT.findall(p)) or p.count('"executive_summary"')
            out.append(json.dumps({
                "executive_summary": f"Offline briefing covering {n} item(s).",
                "categories": {},
                "per_source": [{"source": s, "summary": "", "key_facts": [], "links": []} for s in _FROM.findall(p)],
                "domain_flags": [],
                "active_categories": [],
            }))
        return out
    return run


def failing_model(output_tokens: int) -> Model:
    """As ``offline_model``, but a prompt with the words "call fails" is refused."""
    answer = offline_model(output_tokens)

    def run(prompts: list[str]) -> list[str]:
        if any("call fails" in p for p in prompts):
            raise RuntimeError("refused")
        return answer(prompts)
    return run
