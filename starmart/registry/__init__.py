"""Named queries over the driver tables, with the SQL they must agree with."""
