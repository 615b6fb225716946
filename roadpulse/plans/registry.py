"""All registered queries."""

from __future__ import annotations

from roadpulse.plans import graphs, measures, models, rolling, roundtrips, shaping, sources, streams

_PARTS = [sources, shaping, rolling, measures, graphs, models, streams, roundtrips]

QUERIES = {key: query for part in _PARTS for key, query in part.QUERIES.items()}
ORACLES = {key: text for part in _PARTS for key, text in part.ORACLES.items()}
