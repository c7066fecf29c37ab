-- Units and amount of awards per month, institution and product, newest years only.
-- Awards are summed per site before the sites are looked up.
with per_site as (
    select annual, mes, clave_clues, clave_cbycm,
           sum(cast(piezas as decimal(28, 6))) as units,
           sum(cast(importe_max as decimal(28, 6))) as amount
    from {awards}
    where cast(annual as int) >= (select max(cast(annual as int)) from {awards}) - :years
    group by annual, mes, clave_clues, clave_cbycm
)
select concat_ws('-', annual, lpad(mes, 2, '0'), '01') as month_date,
       institucion,
       clave_cbycm as product_id,
       sum(units) as units,
       sum(amount) as amount
from per_site
join {sites} using (clave_clues)
where array_contains(:institutions, institucion)
group by annual, mes, institucion, clave_cbycm
