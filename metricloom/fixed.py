"""Fixed values.

Every constant here is part of the data contract: names, limits, markers and
the reserved-word list decide what a stored name or key looks like, so they
are stated as they are and not derived.
"""

from __future__ import annotations

# Label and column names.
NAME_LABEL = "__name__"
TAG_PREFIX = "t_"
TEXT_SUFFIX = "_str"
SOURCE_TAG = "srcip"
FIELD_TAG = "field"
KEY_PREFIX = "MD5_"

# Lengths in bytes, counts and sizes.
METRIC_NAME_BYTES = 190
AGENT_TABLE_BYTES = 160
AGENT_TAG_NAME_BYTES = 64
AGENT_TAG_VALUE_BYTES = 59
AGENT_TAG_DECLARED_BYTES = 30
TAG_VALUE_BYTES = 128
TAGS_PER_SERIES = 128
TAGHASH_BYTES = 34
TEXT_VALUE_BYTES = 256
SOURCE_TAG_BYTES = 20
FIELD_TAG_BYTES = 40

# Default namespaces and batch sizes.
REMOTE_NAMESPACE = "prometheus"
AGENT_NAMESPACE = "telegraf"
REMOTE_BATCH_SIZE = 100
AGENT_BATCH_SIZE = 10

# Markers of the two line kinds in a metric log.
LOG_VALUE_MARKER = "server.go:201:"
LOG_LABEL_MARKER = "server.go:202:"

# Words an agent name may not be; such a name gets a leading "_".
RESERVED_WORDS = tuple(
    """
    ablocks abort account accounts add after all alter and as asc attach avg
    before begin between bigint binary bitand bitnot bitor bool bottom by
    cache cascade change clog cluster colon column comma comp concat configs
    conflict connection connections copy count create ctime
    database databases days deferred delimiters desc describe detach diff
    distinct divide dnode dnodes dot double drop
    each end eq exists explain
    fail fill first float for from
    ge glob grants group gt
    having
    id if ignore immediate import in initially insert instead integer
    interval into ip is isnull
    join
    keep key kill
    last le leastsquares like limit linear local lp lshift lt
    match max metric metrics min minus mnodes modules
    nchar ne none not notnull now
    of offset or order
    pass percentile plus pragma prev privilege
    queries query
    raise rem replace replica reset restrict row rows rp rshift
    scores select semi set show slash sliding slimit smallint spread stable
    stables star statement stddev stream streams string sum
    table tables tag tags tblocks tbname times timestamp tinyint top topic
    trigger
    uminus uplus use user users using
    values variable vgroups view
    wavg where
    """.split()
)
