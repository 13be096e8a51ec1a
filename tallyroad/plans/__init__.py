"""The registered queries, their input feed and their SQL counterparts."""
