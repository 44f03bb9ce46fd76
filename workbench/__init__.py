"""Driver tables seen as set-top-box logs, the registered queries and their SQL."""
