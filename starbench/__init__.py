"""The billing tables, derived from the driver's star schema, and the queries over them."""
