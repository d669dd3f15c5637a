"""Named queries over the fixture tables and the scheduled jobs."""
