"""The acquisition-source ladder that the contact and the deal mart share."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from martforge.functions.nulls import eq_or_false, matches, paste
from martforge.functions.rules import ladder

# Fixed values: (pattern of the channel's detail, label) of direct visits beside the own pages, and of paid ones.
DIRECT_BLOG = ("blog", "Direct(blog)")
PAID_DETAILS = (("facebook", "Paid Social(Facebook)"), ("linkedin", "Paid Social(LinkedIn)"),
                ("auto-tagged", "Paid Search(Google)"))
LEAD_FORM = "lead.gen"


def acquisition_source(detail: Column, lead_form: Column, organic: Column, rules, social: Sequence[tuple] = (),
                       last_paid: Sequence[tuple] = (), last: Sequence[tuple] = ()) -> Column:
    """First-match ladder over ``digital_channel``.

    ``detail`` is the channel's detail, ``lead_form`` the column that marks off-platform forms, ``organic`` names an
    organic source; ``social``, ``last_paid`` and ``last`` are a mart's own rules, before, after the paid ones and at the end.
    ``rules`` holds the patterns of the own pages (``own_home``, ``own_site``, ``meeting_host``).
    """
    channel = F.col("digital_channel")
    direct, paid = eq_or_false(channel, "Direct"), eq_or_false(channel, "Paid")
    pages = ((rules.own_home, "Direct(homepage)"), DIRECT_BLOG, (rules.own_site, "Direct(website)"),
             (rules.meeting_host, "Direct(meeting link)"))
    return ladder([
        (paid & matches(lead_form, LEAD_FORM, False), paste("Off-platform(", detail, ")")),
        *[(direct & matches(detail, pattern), label) for pattern, label in pages],
        (direct, "Direct(other)"),
        (eq_or_false(channel, "Organic"), F.lower(organic)),
        *social,
        *[(paid & matches(detail, pattern), label) for pattern, label in PAID_DETAILS],
        *[(paid & cond, label) for cond, label in last_paid],
        *last,
    ], default="Other")
