-- Stock and consumption per month, institution and product over three lake tables, each with
-- its own measure of consumption and cut to its own newest years. Stacked and summed once.
with stacked as (
    select 'CENSIDA' as institucion, annual, mes, clave_cbycm, inventario, consumo_autorizado as consumption
    from {third_table}
    where cast(annual as int) >= (select max(cast(annual as int)) from {third_table}) - :years
    union all
    select 'IMSS', annual, mes, clave_cbycm, inventario, cpm_r
    from {first_table}
    where cast(annual as int) >= (select max(cast(annual as int)) from {first_table}) - :years
    union all
    select 'ISSSTE', annual, mes, clave_cbycm, inventario, dpn
    from {second_table}
    where cast(annual as int) >= (select max(cast(annual as int)) from {second_table}) - :years
)
select concat_ws('-', annual, lpad(mes, 2, '0'), '01') as month_date,
       institucion,
       clave_cbycm as product_id,
       sum(cast(inventario as decimal(28, 6))) as stock,
       sum(cast(consumption as decimal(28, 6))) as consumption
from stacked
group by annual, mes, institucion, clave_cbycm
