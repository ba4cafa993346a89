"""A sender for checks and tests: it delivers nowhere."""

from __future__ import annotations

from passerine.plans.delivery import Sender, SenderFactory


def fail_when_last_digit_in(digits: str) -> SenderFactory:
    """A sender that delivers nowhere and fails payloads whose last digit is listed; for checks."""
    def factory() -> Sender:
        def send(payloads: list[str], topic: str | None) -> list[str | None]:
            last = [[c for c in p if c.isdigit()][-1:] for p in payloads]
            return ["refused" if d and d[0] in digits else None for d in last]

        return send

    return factory
