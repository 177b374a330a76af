"""DataFrame -> DataFrame operators: row generators, dedupe, partitions,
curators, envelopes, payload quality and the traffic expectation model."""
