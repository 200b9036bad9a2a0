"""DataFrame transforms. Each is a plain function that works on batch input and,
where it has no global order, on a stream as well."""
