"""Job parameters (one frozen object passed to every operator)."""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass, replace


@dataclass(frozen=True)
class Params:
    # Fixed values that must equal the reference's for the same results.
    label: str = "Newsletter"          # default mailbox label
    max_messages: int | None = 30      # messages kept per (day, label), in list order
    max_input_tokens: int = 75000      # token budget per model call
    chars_per_token: int = 4           # token estimate = chars // 4
    prompt_overhead: int = 2000        # tokens added for the prompt text
    message_overhead: int = 200        # tokens added per message when packing chunks
    body_cap: int = 15000              # characters kept per body
    min_body: int = 50                 # stripped bodies shorter than this are dropped
    output_tokens: int = 4096          # model output limit per call
    block_limit: int = 100             # top-level blocks per page
    text_limit: int = 2000             # characters per text item on a page
    # Our own: what happens when the model is busy.
    busy_tries: int = 8                # repeats of one call before its prompts are errors
    busy_budget: int = 1000            # repeats of all calls of one task
    busy_wait: float = 1.0             # seconds before the first repeat; doubled each time
    busy_wait_most: float = 60.0       # longest wait

    def with_(self, **kw) -> "Params":
        return replace(self, **kw)


DEFAULT = Params()


def target_day(date: str | None = None, today: bool = False,
               now: _dt.datetime | None = None) -> _dt.date:
    """The day to brief (C3): an explicit YYYY-MM-DD date, else today if asked,
    else yesterday. A malformed date raises ValueError (validated on the driver)."""
    if date is not None:
        return _dt.datetime.strptime(date, "%Y-%m-%d").date()
    now = now or _dt.datetime.now()
    return now.date() if today else (now - _dt.timedelta(days=1)).date()
