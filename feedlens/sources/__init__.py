from feedlens.sources.actions import (  # noqa: F401
    Actions, FEED_SCHEMA, MESSAGE_SCHEMA, check_schema, feed_from_events,
    load_fixture, message_from_events, read_actions, read_jdbc, register_views,
)
