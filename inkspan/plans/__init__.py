"""Compositions of the operators as registered queries, with the SQL that answers alike."""

from inkspan.plans import audits, dates, feeds, geocode, items, layouts, recovery, reports, roundtrips, rules, streams, texts, work  # noqa: F401
