"""packetloom: preparing packet recordings as Spark DataFrame jobs.

One row is one packet; a recording is the set of rows that share ``recording_id``
(and ``sample_index`` for tensors holding many clips).  Everything here takes and
returns DataFrames built from Spark's own functions.
"""
