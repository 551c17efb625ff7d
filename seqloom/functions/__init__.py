"""Part of seqloom."""
